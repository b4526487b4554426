"""Secret scanning over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by the SHA-256 of its UTF-8 bytes. A ledger
in Parquet records which rule versions each blob has been scanned with and what
they found. A scan reads only pairs of blob and rule version the ledger lacks,
appends them, and joins the findings back to every path that holds the blob.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_work_dir
from .common import map_rows


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A change of the pattern needs a new ``version``.

    The whole match is reported when ``group`` has ``least`` characters or more.
    ``hints`` are lower-case texts of which any match holds one; a text without
    them is not searched.
    """

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The forms of well-known credentials.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
        hints=("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=16, hints=("akia",)),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{32,}"),
)
FURTHER_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hints=("private key-----",)),
    Rule("jwt", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40, hints=("eyj",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]+", least=40, hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]+", least=15, hints=("xox",)),
    Rule("google", 1, r"AIza[A-Za-z0-9_-]+", least=39, hints=("aiza",)),
    Rule("bearer", 1, r"(?ai:bearer)\x20+([A-Za-z0-9._~+/=-]+)", group=1, least=20, hints=("bearer",)),
)
RULES = BASE_RULES + FURTHER_RULES

FINDING = "struct<start:bigint,rank:int,kind:string,stop:bigint,rule:string>"
LEDGER = f"blob_id binary, done array<string>, findings array<{FINDING}>"


def find_secrets(text: str, rules: tuple[Rule, ...]) -> list[dict]:
    """Leftmost non-overlapping matches per rule, by start, then by rule."""
    lower = text.lower()
    found = []
    for rank, rule in enumerate(rules):
        if rule.hints and not any(hint in lower for hint in rule.hints):
            continue
        for match in re.finditer(rule.pattern, text):
            if match.end(rule.group) - match.start(rule.group) >= rule.least:
                found.append(
                    {"start": match.start(), "rank": rank, "kind": rule.kind, "stop": match.end(), "rule": rule.key}
                )
    return sorted(found, key=lambda f: (f["start"], f["rank"]))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or an empty one where none has been written yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan_versions(
    versions: DataFrame,
    path_columns: list[str],
    text_column: str,
    ledger_path: str | None = None,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Scan what the ledger has not seen; return findings for every row of ``versions``.

    Returns ``path_columns``, ``blob_id`` (32 bytes) and ``findings``, an array of
    (start, rank, kind, stop, rule) by start, then rule order; offsets are code
    points, stop exclusive. One output row per input row: repeated rows stay, a
    null text counts as empty, null paths are kept, an empty table gives an empty
    result, other columns are ignored. Without ``ledger_path`` a new ledger is
    written below the shared work folder. Paths may not be named ``blob_id`` or
    ``findings``.
    """
    if {"blob_id", "findings"} & set(path_columns):
        raise ValueError("path columns may not be named blob_id or findings")
    spark = versions.sparkSession
    ledger_path = ledger_path or shared_work_dir(spark, "secret-ledger")
    text = F.coalesce(versions[text_column], F.lit(""))
    blob_id = F.unhex(F.sha2(text, 256))
    current = [rule.key for rule in rules]

    # One shuffle of the distinct texts; the ledger joins in the same partitioning.
    blobs = versions.select(blob_id.alias("blob_id"), text.alias("text")).dropDuplicates(["blob_id"])
    seen = read_ledger(spark, ledger_path).groupBy("blob_id").agg(F.flatten(F.collect_list("done")).alias("done"))
    missing = F.array_except(F.array(*map(F.lit, current)), F.coalesce("done", F.array().cast("array<string>")))
    unseen = blobs.join(seen, "blob_id", "left").select("blob_id", "text", missing.alias("rules")).where(F.size("rules") > 0)

    def scan(batch: dict):
        findings = []
        for text, keys in zip(batch["text"], batch["rules"]):
            wanted = {rule.key for rule in rules if rule.key in keys}
            findings.append([f for f in find_secrets(text, rules) if f["rule"] in wanted] if wanted else [])
        yield {"blob_id": batch["blob_id"], "done": batch["rules"], "findings": findings}

    map_rows(unseen, scan, LEDGER).write.mode("append").parquet(ledger_path)

    found = (
        read_ledger(spark, ledger_path)
        .select("blob_id", F.filter("findings", lambda f: f["rule"].isin(current)).alias("findings"))
        .where(F.size("findings") > 0)
        .groupBy("blob_id")
        .agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings"))
    )
    paths = versions.select(*[versions[c] for c in path_columns], blob_id.alias("blob_id"))
    return paths.join(found, "blob_id", "left").select(
        *path_columns, "blob_id", F.coalesce("findings", F.array().cast(f"array<{FINDING}>")).alias("findings")
    )
