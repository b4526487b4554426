"""Reports over the star schema.

Each report filters the fact, joins the small dimensions (dates, accounts,
products) and adds up. Join strategies are left to the optimizer: it
broadcasts a dimension when its measured size allows, and then the fact is not
shuffled at all before it is added up on the map side; otherwise it merges,
splitting skewed partitions. The tag dimension can be large and one tag
combination very common, so rows are added up by tag key before that join.
Sums of sums are the same sums.

``excluded`` defaults to the charge types the amortized reports leave out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.calendar import in_time_range
from tallyfold.functions.fixed_values import NON_USAGE_CHARGES
from tallyfold.plans.star import PRODUCT_KEY, TAG_KEY, USAGE_MONTH, Star

COST = "amortized_cost"
ACCOUNT_KEY = "aws_account_dim_id"
DATE_KEY = "date_dim_id"


def day_ids(first: dt.date, last: dt.date) -> list[str]:
    return [(first + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((last - first).days + 1)]


def total_by(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(COST).alias(COST))


def _all(*tests: Column | None) -> Column:
    combined = F.lit(True)
    for test in tests:
        if test is not None:
            combined = combined & test
    return combined


def _report(
    star: Star,
    *by: str,
    tests: Sequence[Column | None] = (),
    excluded: Sequence[str] = NON_USAGE_CHARGES,
    account: DataFrame | None = None,
    date: DataFrame | None = None,
    product: DataFrame | None = None,
    tag: DataFrame | None = None,
    where: Column | None = None,
    months: Column | None = None,
) -> DataFrame:
    """Cost of the fact rows passing ``tests``, joined to the given
    dimensions (already filtered), per ``by``. ``where`` tests joined rows.

    ``months`` tells the months of usage that ``tests`` or a filtered date
    dimension leave; a stored fact is partitioned by them. The account
    dimension has a row per payer and account; a report takes an account once.
    """
    kept = ~F.col("charge_type").isin(*excluded) if excluded else None
    pruned = months if USAGE_MONTH in star.fact.columns else None
    rows = star.fact.where(_all(pruned, kept, *tests))
    if account is not None:
        account = account.select(ACCOUNT_KEY, "account_name").distinct()
    for key, dim in ((PRODUCT_KEY, product), (DATE_KEY, date), (ACCOUNT_KEY, account)):
        if dim is not None:
            rows = rows.join(dim, key)
    if where is not None:
        rows = rows.where(where)
    if tag is not None:
        rows = total_by(rows, *[c for c in by if c not in tag.columns], TAG_KEY).join(tag, TAG_KEY)
    return total_by(rows, *by)


def _on_days(days: Iterable[str] | None = None, prefix: str | None = None) -> Column | None:
    if days is not None:
        return F.col(DATE_KEY).isin(*days)
    return None if prefix is None else F.col(DATE_KEY).startswith(prefix)


def _usage_months(
    days: Iterable[str] | None = None, prefix: str | None = None, year: str | None = None, month: str | None = None
) -> Column | None:
    """The partitions of a stored fact that hold the days, the prefix or the month."""
    number = F.col(USAGE_MONTH)
    if days is not None:
        return number.isin(*sorted({int(day[:6]) for day in days}))
    prefix = prefix if prefix is not None else (year or "") + (month or "" if year else "")
    if len(prefix) >= 6:
        return number == int(prefix[:6])
    return number.between(int(prefix[:4]) * 100, int(prefix[:4]) * 100 + 99) if len(prefix) >= 4 else None


def _account_named(star: Star, name: str | None) -> DataFrame:
    return star.account if name is None else star.account.where(F.col("account_name") == name)


def _month(star: Star, year: str | None, month: str | None) -> DataFrame:
    return star.date.where(
        _all(
            None if year is None else F.col("year_attr") == year,
            None if month is None else F.col("month_attr") == month,
        )
    )


def _on_account(account: str | None) -> Column | None:
    return None if account is None else F.col(ACCOUNT_KEY) == account


def _service(star: Star, name: str | None) -> DataFrame:
    return star.product if name is None else star.product.where(F.col("product_servicename") == name)


def by_account(star: Star) -> DataFrame:
    """R1. Amortized cost per account name."""
    return _report(star, "account_name", account=star.account)


def by_account_day_service(
    star: Star, *, service: str, account_name: str, days: Iterable[str] | None = None, day_prefix: str | None = None
) -> DataFrame:
    """R2, R3. One service of one account per day, newest first."""
    return _report(
        star,
        "account_name",
        DATE_KEY,
        "product_servicename",
        tests=[_on_days(days, day_prefix)],
        months=_usage_months(days, day_prefix),
        account=_account_named(star, account_name),
        product=_service(star, service),
    ).orderBy(F.desc(DATE_KEY))


def by_day_and_tag(star: Star, tag: str, *, account: str, year: str, month: str, value: str | None = None) -> DataFrame:
    """R4. One account's month per day and tag value."""
    return _report(
        star,
        DATE_KEY,
        tag,
        tests=[_on_account(account)],
        months=_usage_months(year=year, month=month),
        date=_month(star, year, month),
        account=star.account,
        tag=star.tag if value is None else star.tag.where(F.col(tag) == value),
    ).orderBy(DATE_KEY, tag)


def by_month_and_service(
    star: Star,
    *,
    service: str | None = None,
    year: str | None = None,
    month: str | None = None,
    excluded: Sequence[str] = (),
) -> DataFrame:
    """R5. Per year, month and service, through all four dimensions."""
    return _report(
        star,
        "year_attr",
        "month_attr",
        "product_servicename",
        excluded=excluded,
        months=_usage_months(year=year, month=month),
        date=_month(star, year, month),
        account=star.account,
        product=_service(star, service),
        tag=star.tag,
    ).orderBy("year_attr", "month_attr")


def by_account_day(
    star: Star, *, days: Iterable[str], account: str | None = None, account_name: str | None = None
) -> DataFrame:
    """R6. Account per day."""
    return _report(
        star,
        "account_name",
        DATE_KEY,
        tests=[_on_days(days), _on_account(account)],
        months=_usage_months(days),
        account=_account_named(star, account_name),
    ).orderBy(F.desc(DATE_KEY))


def by_account_and_service(star: Star, *, service: str, account_name: str, days: Iterable[str]) -> DataFrame:
    """R7. One service of one account over some days."""
    return _report(
        star,
        "account_name",
        "product_servicename",
        tests=[_on_days(days)],
        months=_usage_months(days),
        account=_account_named(star, account_name),
        product=_service(star, service),
    ).orderBy("product_servicename")


def account_total(
    star: Star,
    *,
    account_name: str | None = None,
    days: Iterable[str] | None = None,
    day_prefix: str | None = None,
    with_id: bool = False,
) -> DataFrame:
    """R8. Accounts over some days or a month, highest first."""
    by = ["account_name", ACCOUNT_KEY] if with_id else ["account_name"]
    return _report(
        star,
        *by,
        tests=[_on_days(days, day_prefix)],
        months=_usage_months(days, day_prefix),
        account=_account_named(star, account_name),
        product=star.product,
    ).orderBy(F.desc(COST))


def by_service_and_charge(
    star: Star,
    *,
    service_prefix: str,
    account_name: str | None = None,
    account: str | None = None,
    day_prefix: str | None = None,
    with_day: bool = False,
) -> DataFrame:
    """R9. Services with a name prefix by charge type, all charges, highest first."""
    by = [DATE_KEY] if with_day else []
    return _report(
        star,
        *by,
        "product_servicename",
        "charge_type",
        tests=[_on_days(prefix=day_prefix), _on_account(account)],
        months=_usage_months(prefix=day_prefix),
        excluded=(),
        account=_account_named(star, account_name),
        product=star.product.where(F.col("product_servicename").startswith(service_prefix)),
    ).orderBy(F.desc(COST))


def by_service_and_charge_or_prefix(
    star: Star, *, account_name: str, day_prefix: str, service_prefix: str, or_prefix: str
) -> DataFrame:
    """R10. As R9 for one account and month, *or* any service with the second
    prefix (of every account and day: AND binds before OR)."""
    name = F.col("product_servicename")
    either = (
        (F.col("account_name") == account_name) & F.col(DATE_KEY).startswith(day_prefix) & name.startswith(service_prefix)
    ) | name.startswith(or_prefix)
    return _report(
        star,
        "product_servicename",
        "charge_type",
        excluded=(),
        account=star.account,
        product=star.product,
        where=either,
    ).orderBy(F.desc(COST))


def by_purchase_option(
    star: Star,
    *,
    account: str,
    year: str,
    month: str,
    not_service: str,
    excluded: Sequence[str] = ("Refund", "Credit", "Tax"),
) -> DataFrame:
    """R11. One account's month per purchase option, without one service."""
    return _report(
        star,
        "purchase_option",
        tests=[_on_account(account), _on_days(prefix=year + month)],
        months=_usage_months(prefix=year + month),
        excluded=excluded,
        date=_month(star, year, month),
        account=star.account,
        product=star.product.where(F.col("product_servicename") != not_service),
        tag=star.tag,
    ).orderBy("purchase_option")


def purchase_option_total(star: Star, *, account: str, year: str, month: str, option: str) -> DataFrame:
    """R12. One account's month for one purchase option, as one total."""
    return _report(
        star,
        tests=[_on_account(account), F.col("purchase_option") == option, _on_days(prefix=year + month)],
        months=_usage_months(prefix=year + month),
        date=_month(star, year, month),
        account=star.account,
        product=star.product,
        tag=star.tag,
    )


def period_total(
    star: Star,
    *,
    account: str,
    year: str,
    month: str,
    days: Iterable[str],
    payer: str | None = None,
    squad: str | None = None,
    by_day: bool = False,
) -> DataFrame:
    """R13. One account over some days: in total or per day, optionally for
    one squad or under one payer."""
    total = _report(
        star,
        *([DATE_KEY] if by_day else []),
        tests=[_on_account(account), _on_days(days)],
        months=_usage_months(days),
        date=_month(star, year, month),
        account=star.account if payer is None else star.account.where(F.col("bill_payer_account_id") == payer),
        tag=star.tag if squad is None else star.tag.where(F.col("resource_tags_user_squad") == squad),
    )
    return total.orderBy(DATE_KEY) if by_day else total


def average_coverage(series: DataFrame, column: str, month_prefix: str) -> DataFrame:
    """R14. Mean of a coverage column (stored as text) over a month."""
    chosen = series.where(F.col(DATE_KEY).startswith(month_prefix))
    return chosen.agg(F.avg(F.col(column).try_cast("double")).alias("average_coverage"))


def resource_history(usage: DataFrame, resource: str, day_prefix: str) -> DataFrame:
    """R15. One resource's usage, newest day first."""
    parts = (("year", day_prefix[:4], 4), ("month", day_prefix[4:6], 2))
    partitions = [F.col(name) == int(text) for name, text, size in parts if len(text) == size]
    chosen = usage.where(_all(*partitions, F.col("resource") == resource, F.col(DATE_KEY).startswith(day_prefix)))
    return chosen.orderBy(F.desc(DATE_KEY))


def activity_log(
    log: DataFrame, users: DataFrame, *, as_of, older_than_hours: int = 6, newer_than_hours: int = 12
) -> DataFrame:
    """R16. Log entries of a sliding time range with their users, newest first.

    ``log``: user_id, database, query, start_time, end_time, aborted (0/1).
    ``users``: user_id, username.
    """
    window = in_time_range(
        F.col("start_time"), as_of, older_than_hours=older_than_hours, newer_than_hours=newer_than_hours
    )
    return (
        log.where(window)
        .join(users, "user_id")
        .select(
            "username",
            "database",
            "query",
            "start_time",
            "end_time",
            F.when(F.col("aborted") == 1, "YES").otherwise("NO").alias("aborted"),
        )
        .orderBy(F.desc("start_time"))
    )
