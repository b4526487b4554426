"""Line-first quality rules, in SQL expressions only.

Lines are judged one by one (navigation, boilerplate, symbol noise, fragments),
failing lines are removed, and a document is rejected when too much of its text
went with them, or when one of the base measures fails.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "[#*$%&|<>]"
# Letters, marks, digits and the underscore make words in any script. Classes are spelled
# out because the short forms mean ASCII to some engines.
_IN = r"[\p{L}\p{M}\p{N}_]"
_NO = r"[^\p{L}\p{M}\p{N}_]"
_SPACE = "[ \\x09-\\x0D]"
# Phrases of site furniture in English, French, German and Spanish, and words that stand behind them, lower case.
_PHRASE = (
    "home|menu|search|log ?in|sign (?:in|up)|register|subscribe|share|next|previous|back to top|"
    "skip to content|read more|click here|"
    "accueil|rechercher|recherche|connexion|se connecter|s['’]inscrire|s['’]abonner|partager|suivant|précédent|"
    "retour en haut|aller au contenu|lire la suite|en savoir plus|cliquez ici|plan du site|"
    "startseite|menü|suche|suchen|anmelden|einloggen|registrieren|abonnieren|teilen|weiter|zurück|nach oben|"
    "zum inhalt springen|weiterlesen|mehr lesen|mehr erfahren|hier klicken|impressum|"
    "inicio|menú|buscar|iniciar sesión|acceder|registrarse|suscribirse|compartir|siguiente|anterior|volver arriba|"
    "(?:ir|saltar) al contenido|leer más|haga clic aquí|mapa del sitio"
)
_BEHIND = (
    "page|pages|post|posts|article|articles|story|entry|chapter|now|here|today|free|all|more|for|to|on|in|with|by|via|"
    "this|our|your|us|my|the|a|an|site|menu|main|content|account|newsletter|mailing|list|updates|facebook|twitter|"
    "linkedin|email|e-mail|rss|link|or|and|about|contact|login|results|"
    "sur|avec|par|et|ou|le|la|les|un|une|cet|cette|notre|votre|compte|lettre|contenu|principal|ici|"
    "auf|mit|per|und|oder|der|die|das|den|diesen|dieser|unser|unseren|konto|seite|artikel|beitrag|hier|zum|zur|"
    "en|con|por|y|o|el|los|las|este|esta|nuestro|cuenta|página|artículo|contenido|aquí"
)
# The whole line: phrases with marks around them, or followed by such words and no sentence end.
NAVIGATION = (
    rf"(?iu)^{_NO}*(?:{_PHRASE})(?:{_NO}+(?:{_PHRASE}))*{_NO}*$|"
    rf"^{_NO}*(?:{_PHRASE})(?:[^\p{{L}}\p{{M}}\p{{N}}_.!?;]+(?:{_PHRASE}|{_BEHIND}))+[^\p{{L}}\p{{M}}\p{{N}}_.!?;]*$"
)
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "we use cookies",
    "enable javascript",
    "lorem ipsum",
    "powered by",
    "©",
    "tous droits réservés",
    "mentions légales",
    "politique de confidentialité",
    "conditions d'utilisation",
    "nous utilisons des cookies",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "nutzungsbedingungen",
    "wir verwenden cookies",
    "todos los derechos reservados",
    "política de privacidad",
    "términos de uso",
    "utilizamos cookies",
)
# Signs that a line with a stock phrase is furniture; any one will do.
FURNITURE_SIGNS = (
    rf"(?iu)(?:^|{_NO})copyright(?:$|{_NO})",
    rf"(?iu)^{_NO}*powered by{_SPACE}[^.!?;]*$",
    rf"(?iu)(?:^|{_NO})(?:https?://|www\.)",
    r"[|•]|^[^«‹]*[»›][^«‹]*$",
    rf"(?iu)(?:^|{_NO})(?:you (?:agree|accept|consent)|by (?:using|continuing|browsing|visiting|clicking|signing|subscribing)|"
    rf"click|learn more|read our|en (?:utilisant|poursuivant|naviguant|cliquant)|vous acceptez|mit der nutzung|"
    rf"stimmen sie|al (?:usar|continuar|navegar)|usted acepta|acepta)(?:$|{_NO})",
    rf"(?iu)(?:^|{_NO})(?:this (?:web ?)?site|our (?:web ?)?site|browser|your experience|contact us|site ?map|your inbox|"
    rf"unsubscribe|(?:ce|notre) site|navigateur|contactez-nous|(?:diese|unsere) (?:web)?seite|diese website|kontakt|"
    rf"(?:este|nuestro) sitio|navegador|contacto)(?:$|{_NO})",
)
SENTENCE_END = rf"[.!?;…。！？][\"'”’»)\]]*{_SPACE}*$"
FRAGMENT_END = rf"[.!?:;…。！？][\"'”’»)\]]*{_SPACE}*$"
_VISIBLE = "[^ \\x09-\\x0D]"
THREE_WORDS = rf"{_VISIBLE}{_SPACE}+{_VISIBLE}+{_SPACE}+{_VISIBLE}"
# Scripts that put no spaces between words: a run of ten letters is more than two words.
UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}]{10}"


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; shares are percentages of a line's or text's characters."""

    least_words: int = 50
    repeat_share: int = 50
    symbol_share: int = 10
    letter_share: int = 50
    separators: int = 3
    navigation_length: int = 1_000  # characters of a line from which a list of phrases is no navigation
    stock_length: int = 300  # characters of a line from which stock phrases are a part of a paragraph
    lost_share: int = 50


def words_of(text: Column) -> Column:
    """Words as an array; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]+"), "")


def word_chars(text: Column) -> Column:
    return F.length(F.array_join(words_of(text), ""))


def holds_stock_phrase(text: Column) -> Column:
    lower = F.lower(text)
    return reduce(or_, [F.contains(lower, F.lit(phrase)) for phrase in BOILERPLATE])


def stock_line(line: Column) -> Column:
    """Whether a line is made of stock phrases rather than a sentence that mentions one.

    They make up half of a line without a sentence end, or three quarters of
    any line; or a second phrase or another sign of furniture stands with one.
    """
    lower = F.lower(line)
    phrases = "|".join(BOILERPLATE)
    left = F.length(F.regexp_replace(lower, phrases, ""))
    size = F.length(line)
    held = reduce(add, [F.contains(lower, F.lit(phrase)).cast("int") for phrase in BOILERPLATE])
    signs = reduce(or_, [line.rlike(sign) for sign in FURNITURE_SIGNS])
    return (held > 0) & (
        (held > 1) | ((left * 2 <= size) & ~line.rlike(SENTENCE_END)) | (left * 4 <= size) | signs
    )


def line_fails(line: Column, has_stock_phrase: Column, rules: LineRules) -> Column:
    """Whether a line with words is furniture or noise rather than text.

    Punctuation: one or two words without an end mark, too many symbols, or too
    few letters; scripts written without spaces have no fragments. Navigation:
    known phrases that fill a line below ``navigation_length``, or short items between separators, which
    guillemets are where they do not quote. Boilerplate: stock phrases in a line below
    ``stock_length``, looked for only where ``has_stock_phrase`` says that the text has one.
    """
    size = F.length(line)
    fragment = ~line.rlike(THREE_WORDS) & ~line.rlike(FRAGMENT_END) & ~line.rlike(UNSPACED)
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    filled = F.length(F.regexp_replace(line, f"{_SPACE}+", ""))
    pointing = F.when(line.rlike("[«‹]"), 0).otherwise(F.regexp_count(line, F.lit("[»›]")))
    separators = F.regexp_count(line, F.lit("[|•]")) + pointing
    return (
        fragment
        | (symbols * 100 > size * rules.symbol_share)
        | (letters * 100 < filled * rules.letter_share)
        | ((separators >= rules.separators) & (size < separators * 25))
        | ((size < rules.navigation_length) & line.rlike(NAVIGATION))
        | (has_stock_phrase & (size < rules.stock_length) & stock_line(line))
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value worked out once, wherever the optimizer moves the whole."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words covered by a three-word window found twice or more.

    Windows are told apart by a 64-bit hash. Only texts where some hash repeats are
    sorted by it, so that a window that repeats stands beside its like.
    """

    def covered(placed: Column) -> Column:
        beside = lambda s, k, step: F.get(placed, k + step)["h"] == s["h"]
        starts = F.transform(F.filter(placed, lambda s, k: beside(s, k, -1) | beside(s, k, 1)), lambda s: s["i"])
        return F.aggregate(
            F.sort_array(starts),
            F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")),
            lambda acc, p: F.struct(
                (p + 3).alias("upto"), (acc["n"] + p + 3 - F.greatest(acc["upto"], p)).alias("n")
            ),
            lambda acc: acc["n"],
        )

    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1),
        F.greatest(F.size(words) - 2, F.lit(0)),
    )
    place = lambda hashes: F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(
        windows,
        lambda hashes: F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), let(place(hashes), covered)
        ).otherwise(F.lit(0)),
    )


def verdict(text: Column, rules: LineRules) -> Column:
    """All measures of a text, the verdict and the cleaned text, as a struct."""
    has_word = lambda line: line.rlike("[^ \\x09-\\x0D]")
    long = lambda c: c.cast("bigint")

    measured = let(
        words_of(text),
        lambda ws: F.struct(
            long(F.size(ws)).alias("n_words"),
            long(F.length(F.array_join(ws, ""))).alias("word_chars"),
            long(repeated_words(ws)).alias("n_repeat_words"),
        ),
    )

    def clean(lines: Column) -> Column:
        full = F.filter(lines, has_word)
        passes = lambda stock: F.filter(lines, lambda line: ~(has_word(line) & line_fails(line, stock, rules)))
        return let(
            let(holds_stock_phrase(text), passes),
            lambda passing: F.struct(
                long(let(full, lambda f: F.size(f) - F.size(F.array_distinct(f)))).alias("n_dup_lines"),
                long(F.size(lines) - F.size(passing)).alias("n_lines_removed"),
                F.array_join(passing, "\n").alias("clean_text"),
            ),
        )

    def judge(m: Column, c: Column) -> Column:
        # Only texts that lost a line are measured again.
        left = F.when(c["n_lines_removed"] == 0, m["word_chars"]).otherwise(word_chars(c["clean_text"]))
        lost = m["word_chars"] - left
        failed = (m["n_words"] < rules.least_words) | (
            m["n_repeat_words"] * 100 > m["n_words"] * rules.repeat_share
        )
        return F.struct(
            m["n_words"].alias("n_words"),
            m["word_chars"].alias("word_chars"),
            long(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
            c["n_dup_lines"].alias("n_dup_lines"),
            m["n_repeat_words"].alias("n_repeat_words"),
            c["n_lines_removed"].alias("n_lines_removed"),
            failed.alias("base_failed"),
            (~failed & (lost * 100 <= m["word_chars"] * rules.lost_share)).alias("kept"),
            c["clean_text"].alias("clean_text"),
        )

    return let(measured, lambda m: let(let(F.split(text, "\n"), clean), lambda c: judge(m, c)))


def line_first_quality(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    keep: list[str] | None = None,
    rules: LineRules = LineRules(),
) -> DataFrame:
    """Measures, verdict and cleaned text of every document, in one pass without a shuffle.

    Returns ``id_column``, the columns of ``keep``, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``n_lines_removed``,
    ``base_failed``, ``kept`` and ``clean_text`` (the text without failing lines).
    One row per input row: repeated rows and null ids stay; a null or empty text
    has no words and fails; an empty table gives an empty result; other columns
    are ignored. Equal three-word windows are told by a 64-bit hash within one text.
    """
    keep = [c for c in (keep or []) if c != id_column]
    names = [f"kept_{i}" for i in range(len(keep) + 1)]
    columns = [documents[c] for c in [id_column, *keep]]
    text = F.coalesce(documents[text_column], F.lit(""))
    rows = documents.select(*[c.alias(n) for c, n in zip(columns, names)], text.alias("text"))
    judged = rows.select(*names, verdict(F.col("text"), rules).alias("q"))
    return judged.select(*[F.col(n).alias(c) for n, c in zip(names, [id_column, *keep])], "q.*")
