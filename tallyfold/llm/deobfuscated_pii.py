"""Personal data behind disguises, with spans of the source text.

Detectors run on the text itself and on a normalised copy. Three transducers
make the copy: look-alike characters become ASCII, runs of spelled digits become
digits, and written-out at and dot signs become signs. Each copied character
keeps the source span it came from, so what the detectors find in the copy is
reported in source offsets.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<rank:int,start:bigint,kind:string,stop:bigint,base:boolean>"

EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Characters of other scripts, each before the ASCII one it looks like.
LOOK_ALIKES = dict(
    tuple(pair)
    for pair in (
        "\u0430a \u0435e \u043eo \u0440p \u0441c \u0443y \u0445x \u0456i \u0458j \u0455s \u04bbh \u0501d "
        "\u051bq \u051dw \u0410A \u0412B \u0415E \u041aK \u041cM \u041dH \u041eO \u0420P \u0421C \u0422T "
        "\u0423Y \u0425X \u0406I \u0408J \u0405S \u03b1a \u03bfo \u03c1p \u03bdv \u03b9i \u03bak \u03c4t "
        "\u03c5u \u0391A \u0392B \u0395E \u0396Z \u0397H \u0399I \u039aK \u039cM \u039dN \u039fO \u03a1P "
        "\u03a4T \u03a5Y \u03a7X \u0261g \u0131i \u2113l \u2010- \u2011- \u2012- \u2013- \u2014- \u2212- "
        "\u2024. \u3002. \ufe52. \u00b7. "
    ).split()
)
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Digit words in the languages of the corpus.
DIGIT_WORDS = {
    word: str(digit)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for digit, word in enumerate(words.split())
}
_WORD = "|".join(sorted(DIGIT_WORDS, key=lambda w: (-len(w), w)))
_ITEM = rf"(?:(?<!\w)(?:{_WORD})(?!\w)|[0-9])"
_SIGN = r"(?:(?<!\w)(?:dot|point|punkt|punto|plus|dash|minus|hyphen)(?!\w))"
# Runs of digits and digit words; signs may stand between them.
SPELLED_RUN = re.compile(
    rf"(?:\+|(?<!\w)plus(?!\w))?[\x20,-]*(?:{_ITEM}[\x20,.-]*(?:{_SIGN}[\x20,.-]*)?){{4,}}", re.IGNORECASE
)
SPELLED_ITEM = re.compile(rf"(?<!\w)(?P<word>{_WORD})(?!\w)|(?P<sign>{_SIGN})|(?P<gap>[\x20,]+)", re.IGNORECASE)
DOT_WORDS = ("dot", "point", "punkt", "punto")
ARTICLES = frozenset(("one", "un", "uno"))
LEAST_DIGITS = 9  # of a telephone number
SIGNS = {"dot": ".", "point": ".", "punkt": ".", "punto": ".", "plus": "+", "dash": "-", "minus": "-", "hyphen": "-"}
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = rf"\s*{_OPEN}\s*(?:at|@|arroba|arobase|arobas|ät)\s*{_CLOSE}\s*"
_BARE_DOT = "(?:dot|punkt|punto|point)"
_DOT = rf"\s*{_OPEN}\s*(?:dot|\.|punkt|point|punto)\s*{_CLOSE}\s*"
_ATOM = r"[A-Za-z0-9_%+-]+"
# Ends of domains, asked for where no sign marks the words: common ones and every country's.
_ENDING = (
    "(?:com|org|net|edu|gov|mil|info|biz|name|pro|mobi|dev|app|xyz|online|site|shop|store|tech|cloud|blog|eus|cat|asia|"
    "a[cdefgilmoqrstuwxz]|b[abdefghijmnorstvwyz]|c[acdfghiklmnoruvwxyz]|d[ejkmoz]|e[cegrstu]|f[ijkmor]|"
    "g[abdefghilmnpqrstuwy]|h[kmnrtu]|i[delmnoqrst]|j[emop]|k[eghimnprwyz]|l[abcikrstuvy]|m[acdeghklmnopqrstuvwxyz]|"
    "n[acefgilopruz]|om|p[aefghklmnrstwy]|qa|r[eosuw]|s[abcdeghijklmnorstvxyz]|t[cdfghjklmnortvwz]|u[agksyz]|"
    "v[aceginu]|w[fs]|y[et]|z[amw])(?![A-Za-z0-9-])"
)
ENDING = re.compile(_ENDING, re.IGNORECASE)
KNOWN_END = re.compile(rf"\.{_ENDING}$", re.IGNORECASE)
# Words that no bare address begins its domain with.
_NO_HOST = r"(?!(?:the|an?|this|that|each|every|one|some|any|which|what|no|la|le|el|der|die|das|den|dem)\b)"
# local part, at sign, domain; bare words count only as "at ... dot ...".
DISGUISED = re.compile(
    rf"(?<![A-Za-z0-9_%+.-])(?P<local>{_ATOM}(?:(?:\.|{_DOT}|\x20+{_BARE_DOT}\x20+){_ATOM})*+)"
    rf"(?:(?:{_AT}|\s*@\s*)(?P<domain>[A-Za-z0-9-]+(?:(?:{_DOT}|\s+{_BARE_DOT}\s+|\.)[A-Za-z0-9-]+)+)"
    rf"|\x20+(?:arroba|arobase|arobas)\x20+"
    rf"(?P<named>(?:[A-Za-z0-9-]+(?:{_DOT}|\x20+{_BARE_DOT}\x20+|\.(?=[A-Za-z0-9])))+{_ENDING})"
    rf"|\x20+at\x20+{_NO_HOST}(?P<bare>(?:[A-Za-z0-9-]+(?:{_DOT}|\x20+(?:dot|punkt|punto)\x20+))+{_ENDING}))",
    re.IGNORECASE,
)
DISGUISE_PART = re.compile(
    rf"(?P<at>{_AT}|\s*@\s*|\x20+(?:at|arroba|arobase|arobas)\x20+)|(?P<dot>{_DOT}|\s+{_BARE_DOT}\s+)", re.IGNORECASE
)
DISGUISE_HINT = re.compile(
    rf"{_OPEN}\s*(?:at|@|arroba|arobase|arobas|ät|dot|\.|punkt|point|punto)\s*{_CLOSE}|"
    rf"\b(?:dot|punkt|punto|arroba|arobase|arobas)\b|\s@|@\s",
    re.IGNORECASE,
)
# Dots written out between groups of digits.
DIGIT_DOT = re.compile(rf"(?<=[0-9])(?:{_DOT}|\s+{_BARE_DOT}\s+)(?=[0-9])", re.IGNORECASE)

# Latin letters with accents imitate nothing.
NOT_PLAIN = re.compile(r"[^\x00-\x7f\u00c0-\u00ff]")
# Runs are looked for where four digit words stand within eight words, or one beside digits.
RUN_GAPS = str.maketrans("-,.", "   ")


def _emails(text: str):
    """Matches of local@domain, leftmost first: found from each @, in one pass."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind's place in KINDS, start, stop) of plain identifiers."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((3, m.start(), m.end()))
    return found


class Tape:
    """A text and, per character, the source span it stands for."""

    def __init__(self, text: str):
        self.text, self.start, self.stop = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits) -> None:
        """Replace parts, given as (start, stop, new text) from left to right."""
        text, start, stop, at = [], [], [], 0
        for a, b, new in edits:
            text += (self.text[at:a], new)
            start += self.start[at:a]
            stop += self.stop[at:a]
            start += [self.start[a]] * len(new)
            stop += [self.stop[b - 1]] * len(new)
            at = b
        text.append(self.text[at:])
        start += self.start[at:]
        stop += self.stop[at:]
        self.text, self.start, self.stop = "".join(text), start, stop


def _ascii_of(character: str) -> str:
    """The ASCII text a character imitates; the character where it imitates none."""
    if character in INVISIBLE:
        return ""
    if character in LOOK_ALIKES:
        return LOOK_ALIKES[character]
    plain = unicodedata.normalize("NFKC", character)
    return plain if plain.isascii() and plain.strip() else character


def _look_alike_edits(text: str, known: dict):
    for m in NOT_PLAIN.finditer(text):
        character = m[0]
        plain = known.get(character)
        if plain is None:
            plain = known[character] = _ascii_of(character)
        if plain != character:
            yield m.start(), m.end(), plain


def _may_spell(lower: str) -> bool:
    words = lower.translate(RUN_GAPS).split()
    at = [i for i, word in enumerate(words) if word in DIGIT_WORDS]
    if any(b - a < 8 for a, b in zip(at, at[3:])):
        return True
    return any(
        word[0].isdigit() or word[-1].isdigit() or word in SIGNS
        for i in at
        for word in words[max(0, i - 1) : i] + words[i + 1 : i + 2]
    )


def _run_items(text: str, start: int, stop: int) -> list:
    """Words, signs and gaps of a run, or none where it cannot be an identifier.

    Four digit words are enough. Fewer count where digits and words together are as
    many as the shortest telephone number has, or three dots stand in an address.
    """
    items = list(SPELLED_ITEM.finditer(text, start, stop))
    words = [i for i in items if i["word"]]
    if len(words) >= 4 or not words:
        return items if words else []
    # An article may follow or come before a number that is whole without it.
    digits = sum("0" <= c <= "9" for c in text[start:stop])
    if len(words) == 1 and words[0]["word"].lower() in ARTICLES and digits >= LEAST_DIGITS:
        before, behind = text[start : words[0].start()], text[words[0].end() : stop]
        if not any("0" <= c <= "9" for c in before) or not any("0" <= c <= "9" for c in behind):
            return []
    dots = text.count(".", start, stop) + sum(1 for i in items if i["sign"] and SIGNS.get(i["sign"].lower()) == ".")
    return items if digits + len(words) >= LEAST_DIGITS or dots >= 3 else []


def _spelled_edits(text: str):
    if not _may_spell(text.lower()):
        return
    for run in SPELLED_RUN.finditer(text):
        for item in _run_items(text, run.start(), run.end()):
            if item["word"]:
                yield item.start(), item.end(), DIGIT_WORDS.get(item["word"].lower(), item["word"])
            elif item["sign"]:
                yield item.start(), item.end(), SIGNS.get(item["sign"].lower(), item["sign"])
            elif item.end() < run.end():
                yield item.start(), item.end(), ""


def _digit_dot_edits(text: str):
    if any(c in text for c in "[({<") or any(word in text.lower() for word in DOT_WORDS):
        for m in DIGIT_DOT.finditer(text):
            yield m.start(), m.end(), "."


def _disguise_edits(text: str):
    lower = text.lower()
    if not (any(c in text for c in "[({<@") or any(w in lower for w in ("dot", "punkt", "punto", "arroba", "arobas"))):
        return
    if not (DISGUISE_HINT.search(text) or ("@" in text and "point" in lower)):
        return
    for m in DISGUISED.finditer(text):
        host = m.end("local")
        for part in DISGUISE_PART.finditer(text, m.start(), m.end()):
            if part["at"]:
                host = part.end()
            # Behind a whole domain a word is part of it only if it ends what has no known end.
            elif part.start() > host and part[0].strip().isalpha() and "." in text[host : part.start()]:
                if KNOWN_END.search(text, host, part.start()) or not ENDING.match(text, part.end()):
                    break
            yield part.start(), part.end(), "@" if part["at"] else "."


def find_private(text: str, known: dict | None = None) -> list[dict]:
    """All spans by kind, then start; ``base`` marks those of the text as it is.

    A span from the copy is added unless a base span of its kind contains it: where
    only part of an identifier is disguised, the whole stands beside the base span.
    """
    base = detect(text)
    spans = [(rank, a, b, True) for rank, a, b in base]
    tape = Tape(text)
    for edits in (lambda t: _look_alike_edits(t, {} if known is None else known), _digit_dot_edits, _spelled_edits, _disguise_edits):
        found = list(edits(tape.text))
        if found:
            tape.rewrite(found)
    if tape.text is not text:
        # Base spans of a kind do not overlap: the last one that starts no later is the only one to hold another.
        places = [[(a, b) for rank, a, b in sorted(base) if rank == kind] for kind in range(len(KINDS))]
        for rank, a, b in detect(tape.text):
            start, stop = tape.start[a], tape.stop[b - 1]
            at = bisect_right(places[rank], (start, len(text) + 1)) - 1
            if at < 0 or places[rank][at][1] < stop:
                spans.append((rank, start, stop, False))
    return [
        {"rank": rank, "start": a, "kind": KINDS[rank], "stop": b, "base": is_base}
        for rank, a, b, is_base in sorted(spans)
    ]


def private_spans(documents: DataFrame, id_column: str, text_column: str, keep: list[str] | None = None) -> DataFrame:
    """Spans of personal data in every whole text.

    Returns ``id_column``, the columns of ``keep`` and ``spans``, an array of
    (rank, start, kind, stop, base) by kind, then start, in code points with stop
    exclusive. One row per input row, in one pass without a shuffle: repeated
    rows and null ids stay, a null or empty text has no spans, an empty table
    gives an empty result, other columns are ignored.
    """
    keep = [c for c in (keep or []) if c not in (id_column, text_column)]
    names = [f"kept_{i}" for i in range(len(keep) + 1)]
    columns = [documents[c] for c in [id_column, *keep]]
    rows = documents.select(*[c.alias(n) for c, n in zip(columns, names)], documents[text_column].alias("text"))
    known: dict = {}

    def scan(batch: dict):
        texts = batch.pop("text")
        yield {**batch, "text": texts, "spans": [find_private(t or "", known) for t in texts]}

    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    found = map_rows(rows, scan, f"{schema}, text string, spans array<{SPAN}>")
    return found.select(
        *[F.col(n).alias(c) for n, c in zip(names, [id_column, *keep])], F.col("text").alias(text_column), "spans"
    )


def mask_spans(text, spans):
    """The text with every span replaced by its kind in angle brackets.

    Overlapping spans are masked as one, under the name of the first; of those that
    start together the longest is the first.
    """
    merged = F.aggregate(
        F.transform(
            F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], (-s["stop"]).alias("back"), s["kind"]))),
            lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("stop"), s["kind"].alias("kind")),
        ),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["stop"] <= acc["at"], acc).otherwise(
            F.struct(
                F.greatest(acc["at"], s["stop"]).alias("at"),
                F.concat(
                    acc["out"],
                    F.when(
                        s["start"] >= acc["at"],
                        F.concat(
                            F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                            F.lit("<"), F.upper(s["kind"]), F.lit(">"),
                        ),
                    ).otherwise(F.lit("")),
                ).alias("out"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2147483647))),
    )
    return F.when(F.size(spans) > 0, merged).otherwise(text)
