"""Secrets, personal data, quality, language and HTML against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import deobfuscated_pii as pii
from tallyfold.llm import secret_ledger as secrets
from tallyfold.llm.kernel_langid import predict_language
from tallyfold.llm.line_blocks import SURGE, WINDOW, extract_text, main_texts
from tallyfold.llm.line_quality import LineRules, line_first_quality
from tallyfold.llm.queries import QUERIES

WORD = r"[^\x20\x09-\x0D]+"


def documents(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def plain_secrets(text):
    found = []
    keyword = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in
                       ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    for m in re.finditer(rf"""({keyword})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def plain_private(text):
    found = [(0, "email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((1, "ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((2, "card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((3, "phone", m))
    return [(k, a, b) for _, a, k, b in sorted((r, m.start(), k, m.end()) for r, k, m in found)]


TRICKY = [
    "a@b.com_x@c.org and a@b..c x@y z@1-2.3",
    "_@a.b @a.b a@.b 1.2.3.4.5 1.2.3.256 0001.02.3.4 +1 (2) 3456-78-9",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111110000 +12",
    "PassWord: 'abcdefgh' tokentoken=12345678 api_key='short' paſſword=abcdefgh AKIAAKIAABCDEFGHIJ",
    "f" * 31 + " " + "f" * 32 + "g" + "0" * 64,
]


def test_secrets_equal_plain_regexes(spark, sf):
    texts = documents(spark, sf)
    for row in QUERIES["op1_secret_ledger"](spark, sf).collect():
        want = plain_secrets(texts[row.doc_id])
        count = Counter(k for k, _, _ in want)
        assert (row.n_assign, row.n_access, row.n_hex) == (count["assign"], count["access"], count["hex"])
        assert row.base_sha256 == digest(want)
    for text in TRICKY:
        found = secrets.find_secrets(text, secrets.BASE_RULES)
        assert [(f["kind"], f["start"], f["stop"]) for f in found] == plain_secrets(text)


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = [("a", "token=12345678"), ("b", "token=12345678"), ("c", "nothing")]
    first = spark.createDataFrame(rows, "file string, body string")
    found = {r.file: len(r.findings) for r in secrets.scan_versions(first, ["file"], "body", path, secrets.BASE_RULES).collect()}
    assert found == {"a": 1, "b": 1, "c": 0}
    assert secrets.read_ledger(spark, path).count() == 2
    more = first.union(spark.createDataFrame([("d", "token=12345678"), ("e", "ghp_" + "Z" * 36)], first.schema))
    found = {r.file: len(r.findings) for r in secrets.scan_versions(more, ["file"], "body", path).collect()}
    assert found == {"a": 1, "b": 1, "c": 0, "d": 1, "e": 1}
    done = secrets.read_ledger(spark, path).select(F.explode("done").alias("rule"), "blob_id")
    assert done.count() == done.distinct().count() == 3 * len(secrets.RULES)
    secrets.scan_versions(more, ["file"], "body", path).collect()
    assert secrets.read_ledger(spark, path).select(F.explode("done")).count() == 3 * len(secrets.RULES)


def test_private_equal_plain_regexes(spark, sf):
    texts = documents(spark, sf)
    for row in QUERIES["op3_deobfuscated_pii"](spark, sf).collect():
        want = plain_private(texts[row.doc_id])
        count = Counter(k for k, _, _ in want)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [count[k] for k in pii.KINDS]
        assert row.base_sha256 == digest(want)
    for text in TRICKY:
        base = [(s["kind"], s["start"], s["stop"]) for s in pii.find_private(text) if s["base"]]
        assert base == plain_private(text)


@pytest.mark.parametrize(
    ("kind", "hidden"),
    [
        ("email", "jane.doe [at] example [dot] org"),
        ("email", "jane at example dot com"),
        ("email", "jаne@exаmple.com"),
        ("email", "jane @ example.com"),
        ("phone", "+four nine three zero one two three four five six"),
        ("ip", "one nine two dot one six eight dot zero dot one"),
        ("card", "４１１１ 1111 1111 1111"),
    ],
)
def test_disguises_keep_source_offsets(kind, hidden):
    text = f"Écris à: {hidden}, merci"
    spans = [(s["kind"], text[s["start"] : s["stop"]]) for s in pii.find_private(text)]
    assert (kind, hidden) in spans


def test_clean_text_has_no_disguise():
    text = "We met at the dot of noon; one by one, six of us sat at home. See fig. 3 (at left), or [dot] plots."
    assert pii.find_private(text) == []


@pytest.mark.parametrize(
    ("kind", "hidden"),
    [
        ("ip", "192[.]168[.]1[.]7"),
        ("ip", "10 (dot) 0 (dot) 0 (dot) 1"),
        ("ip", "192 dot 168 dot 1 dot 7"),
        ("ip", "192 dot 168 dot one dot 7"),
        ("phone", "+49 170 one two three 4567"),
        ("card", "4111 1111 one 111 1111"),
        ("email", "jane at example dot us"),
        ("email", "jane at mail dot example dot jp"),
        ("email", "jean arobase exemple point fr"),
        ("email", "jean point dupont arobase exemple point fr"),
        ("email", "jean (arobase) exemple.fr"),
        ("email", "juan arroba ejemplo.com"),
    ],
)
def test_written_out_signs_and_digits(kind, hidden):
    text = f"Voici: {hidden}, merci"
    spans = [(s["kind"], text[s["start"] : s["stop"]]) for s in pii.find_private(text)]
    assert (kind, hidden) in spans


@pytest.mark.parametrize(
    "text",
    [
        "Look at the dot in the middle, at one point in time, at some point it ends; at this dot is a hole.",
        "Version 3 dot 1 came out in 2019, and one in 10 of 1200 users; see point 4 dot 2 dot one.",
        "Un point de vue: 12 345 678 habitants, un quart, deux tiers, le point 3 point 4.",
        "In 1999, 2000 and 2001, one of 30 sat at home. Der Punkt ist rot, am Punkt 3 Punkt 1 steht eins.",
    ],
)
def test_clean_text_stays_clean(text):
    assert pii.find_private(text) == []


def test_an_article_beside_a_number_is_no_part_of_it():
    text = "Tel. +33 1 23 45 67 89 un ami"
    assert [(s["base"], text[s["start"] : s["stop"]]) for s in pii.find_private(text)] == [(True, "+33 1 23 45 67 89")]


@pytest.mark.parametrize("hidden", ["j\u0430ne@example.com", "john dot doe@example.com", "john@mail.example dot com"])
def test_partly_disguised_addresses_are_whole(spark, hidden):
    text = f"Write to {hidden}, please"
    spans = [(s["kind"], text[s["start"] : s["stop"]], s["base"]) for s in pii.find_private(text)]
    assert ("email", hidden, False) in spans and any(base for _, _, base in spans)
    found = pii.private_spans(spark.createDataFrame([(1, text)], "i long, t string"), "i", "t")
    assert found.select(pii.mask_spans(F.col("t"), F.col("spans"))).first()[0] == "Write to <EMAIL>, please"


@pytest.mark.parametrize("text", ["Write to john@mail.example dot matrix fans", "Write to jean@mail.fr dot de facto"])
def test_a_whole_address_takes_in_no_word(text):
    assert [s["base"] for s in pii.find_private(text)] == [True]


def test_mask_merges_overlaps(spark):
    span = "struct<rank:int,start:bigint,kind:string,stop:bigint,base:boolean>"
    frame = spark.createDataFrame(
        [("abcdefgh", [(0, 1, "ip", 4, True), (1, 3, "card", 6, True)]), ("xyz", [])], f"t string, s array<{span}>"
    )
    assert [r[0] for r in frame.select(pii.mask_spans(F.col("t"), F.col("s"))).collect()] == ["a<IP>gh", "xyz"]


def plain_quality(text):
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_equals_plain_counts(spark, sf):
    texts = documents(spark, sf)
    for r in QUERIES["op6_line_quality"](spark, sf).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == plain_quality(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_removes_lines_then_documents(spark):
    prose = [" ".join(f"{w}{i}" for w in "many words of prose stand in this line".split()) + "." for i in "abcdefghij"]
    rows = [
        (1, "\n".join(["Home", *prose[:5], "Read more", *prose[5:], "© 2024 All rights reserved"])),
        (2, "\n".join(f"a{i} | b{i} | c{i} | d{i} | e{i}" for i in range(30))),
        (3, "\n".join(prose)),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in line_first_quality(frame, "doc_id", "text").collect()}
    assert got[1].kept and got[1].clean_text == "\n".join(prose) and got[1].n_lines_removed == 3
    assert not got[2].kept
    assert got[3].kept and got[3].n_lines_removed == 0
    assert line_first_quality(frame, "doc_id", "text").where("kept").count() == 2


def test_quality_keeps_clean_sentences(spark):
    clean = [
        "Next year the company plans to expand.", "Share prices fell sharply on Monday.", "Home prices rose in May",
        "The plant is powered by wind.", "The new privacy policy of the state was debated for weeks.",
        "Lawyers read the terms of use and found nothing in them that was new.", "Search parties set out at dawn.",
    ]
    furniture = [
        "Home", "Next »", "Read more...", "Sign in to your account", "Share this article", "Home | Login | Register",
        "Powered by WordPress", "© 2024 All rights reserved", "Privacy Policy", "Terms of use | Contact us",
        "By using this site you agree to our privacy policy.", "Please enable JavaScript in your browser.",
    ]
    prose = [" ".join(f"{w}{i}" for w in "many words of prose stand in this line".split()) + "." for i in "abcdefghij"]
    frame = spark.createDataFrame([(1, "\n".join([*prose, *clean, *furniture]))], "doc_id bigint, text string")
    row = line_first_quality(frame, "doc_id", "text").first()
    assert row.clean_text.split("\n") == [*prose, *clean] and row.n_lines_removed == len(furniture)


# Lines by the rule that removes them, and lines that all rules leave alone.
HIT = {
    "fragment": ["Two words", "Einwort", "trois·mots ici"],
    "symbols": ["### *** many $$$ signs *** ### in here", "a & b & c & d & e & f & g"],
    "letters": ["2019 2020 2021 2022 2023 was", "12:30 14:45 16:00 18:15 now", "1 2 3 4 5 6 7 a b."],
    "separators": ["Home › Products › Shoes › Running", "One thing | Another thing | A third | A fourth", "Foo » Bar » Baz » Qux here"],
    "navigation": [
        "Read more about our site", "Sign in to your account", "Lire la suite sur notre page",
        "Teilen auf Facebook, Twitter und LinkedIn", "Compartir en Facebook y Twitter", "ZURÜCK | WEITER | NACH OBEN",
        "Partager sur Facebook", "Menü – Suche – Anmelden", "Saltar al contenido principal", "« Précédent · Suivant »",
    ],
    "boilerplate": [
        "© 2024 Example Ltd. All rights reserved.", "Alle Rechte vorbehalten", "Tous droits réservés - Société Exemple",
        "Todos los derechos reservados", "Wir verwenden Cookies. Mit der Nutzung stimmen Sie zu.",
        "En utilisant ce site, vous acceptez la politique de confidentialité.", "Datenschutzerklärung | Kontakt hier unten",
        "Al navegar usted acepta la política de privacidad de este sitio.",
    ],
}
LEFT = [
    "我们昨天在东京的餐厅里看到了新的 menu 觉得非常好吃。", "Вчера в ресторане мы увидели новое menu и были очень довольны.",
    "אתמול ראינו במסעדה menu חדש והיינו מרוצים מאוד.", "Die Firma »Alpha« und »Beta« liefern »Gamma« aus.",
    "Les sociétés « Alpha », « Beta » et « Gamma » livrent le tout.", "Suchen die Kinder noch lange nach dem Ball?",
    "Weiter im Westen beginnt das Gebirge mit seinen Tälern.", "Anterior al siglo pasado no hay ninguna noticia.",
    "Suivant les règles, le conseil se réunit en mai.", "La plante est alimentée par le vent et le soleil.",
    "The old menu was in French and nobody could read it.", "東京の天気は明日も晴れるでしょうと言われています",
    "Share prices fell sharply on Monday.", "Der Datenschutz ist ein Recht aller Bürger des Landes.",
]


def test_each_rule_hits_its_lines_here_and_in_sql(spark):
    import duckdb

    from tallyfold.llm import oracle as O

    hit = [line for lines in HIT.values() for line in lines]
    prose = [" ".join(f"{w}{c}" for w in "many words of prose stand in this line of text".split()) + "." for c in "abcdefghij"]
    rows = [(i, "\n".join([*prose, line])) for i, line in enumerate([*hit, *LEFT])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    judged = line_first_quality(frame, "doc_id", "text").collect()
    removed = {rows[r.doc_id][1].split("\n")[-1] for r in judged if r.n_lines_removed}
    assert removed == set(hit), (set(hit) - removed, removed - set(hit))
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    found = connection.execute(O.QUALITY).fetchall()
    columns = [d[0] for d in connection.description]
    assert sorted(found) == sorted(tuple(r[c] for c in columns) for r in judged)


def test_very_long_lines_of_any_kind(spark):
    lines = ["next " * 50_000, "-" * 200_000, "a | " * 50_000, "©" * 100_000, "Wort, " * 40_000, "词" * 100_000]
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    removed = {r.doc_id for r in line_first_quality(frame, "doc_id", "text").collect() if r.n_lines_removed}
    assert removed == {1, 2, 3}


def test_stock_phrases_in_a_long_line_are_part_of_it(spark):
    line = "By using this site you accept our terms of use. " + "It goes on with much text. " * 12
    prose = [" ".join(f"{w}{c}" for w in "many words of prose stand in this line of text".split()) + "." for c in "abcdefghij"]
    frame = spark.createDataFrame([(1, "\n".join([*prose, line]))], "doc_id bigint, text string")
    count = lambda n: line_first_quality(frame, "doc_id", "text", rules=LineRules(stock_length=n)).first().n_lines_removed
    assert (count(300), count(1000)) == (0, 1)


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op4_kernel_langid"](spark, sf).collect() if r.held_out]
    right = sum(truth[r.doc_id] == r.lang_pred for r in rows)
    assert len(rows) > 200 and right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_sample_is_bounded_by_rows(spark):
    from tallyfold.llm.kernel_langid import labelled_sample

    rows = [(777, "viele gleiche Worte", "de")] * 500 + [(i, f"some words {i}", "en") for i in range(300)]
    rows += [(9_000, "une langue " * 5_000, "fr"), (9_001, "deux langues " * 5_000, "fr")]  # no short text
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    take = lambda *a: labelled_sample(frame, "doc_id", "text", "lang", F.lit(True), *a)
    sample = Counter(label for _, label in take(50, 64_000, 20_000))
    assert sample == {"de": 50, "en": 50, "fr": 1}
    assert Counter(label for _, label in take(50, 6, 20_000)) == {"de": 2, "en": 2, "fr": 1}
    assert set(label for _, label in take(50, 2, 20_000)) == {"de", "en"}
    said = {r.doc_id: r.lang_pred for r in predict_language(frame, "doc_id", "text", "lang", learn=F.lit(True)).collect()}
    assert (said[777], said[5], said[9_000]) == ("de", "en", "fr")


def test_many_labels(spark):
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{k}" for k in range(30)), f"l{i % 300}") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert predict_language(frame, "doc_id", "text", "lang", learn=F.lit(True)).count() == 600


def test_html_without_and_with_article():
    body = "<p>First &amp; <b>main</b> paragraph of the text, long enough.</p><p>Second   one,\n also long enough to count.</p>"
    want = "First & main paragraph of the text, long enough.\nSecond one, also long enough to count."
    around = (
        "<head><title>t</title></head><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use cookies.</div>"
        "{}<div id=comments><p>A long comment by some reader that says nothing new.</p></div>"
        "<form><p>Write to us, do write to us, please do write.</p></form><footer>&copy; us</footer><!-- <p>x</p> -->"
    )
    assert extract_text(around.format(body)) == want
    assert extract_text(around.format(f"<article>{body}<aside>Advert text, long and loud.</aside></article>")) == want
    assert extract_text('<script>var t="</p>";</script><p>Only this text stays, with enough characters.') == (
        "Only this text stays, with enough characters."
    )
    inline = '<article><p>One <span class="ad">Buy!</span>two <img alt="hidden"> <b data-id="ad-1">three</b>.</p></article>'
    assert extract_text(inline) == "One two three."
    around_block = "<article><p>Kept <span class='promo'><div>Gone</div> gone</span> text</p></article>"
    assert extract_text(around_block) == "Kept text"
    assert extract_text(None) == extract_text("") == extract_text("<div class='ad'>x</div>") == ""


BODY = "<p>First paragraph of a text that is long enough to count.</p><p>Second one, long enough as well, no doubt.</p>"
TEXT = "First paragraph of a text that is long enough to count.\nSecond one, long enough as well, no doubt."


def test_teasers_do_not_bound_the_text():
    page = f"<div>{BODY}</div><article><a href=x>Teaser</a><p>Short teaser.</p></article>"
    assert extract_text(page).startswith(TEXT)


@pytest.mark.parametrize(
    "page",
    [
        "<svg width='1'/><article>{}</article>", "<svg><path/><article>{}</article>", "<style-guide></style-guide>{}",
        "<title-bar></title-bar><main>{}</main>", "<div class='site has-sidebar'>{}</div>", "<form>{}</form>",
        "<div class='no-comments'>{}</div>", "<div class='page-sidebar'>{}<div class=sidebar>Side</div></div>",
    ],
)
def test_articles_do_not_vanish(page):
    assert extract_text(page.format(BODY)) == TEXT


def test_a_long_footer_is_no_text():
    assert extract_text(f"<article><p>A short note.</p></article><footer>{BODY}</footer>") == "A short note."


def test_short_lines_stay():
    assert extract_text("<p>Short text.</p><p>End.</p>") == "Short text.\nEnd."
    assert extract_text(f"<h1>Title</h1><p>By me</p><p>May</p><p>Now</p>{BODY}") == f"Title\nBy me\nMay\nNow\n{TEXT}"
    advert = "<div class=ad><p>Buy</p><p>this</p><p>now</p></div>"
    assert extract_text(f"{BODY}{advert}<p>Thanks.</p>") == f"{TEXT}\nThanks."


LINKS = "".join(f"<li><a href=x{i}>Link number {i} to another page of this site</a></li>" for i in range(20))


def test_text_ends_where_it_dives():
    """Behind a run of links short lines are no text; a long enough one begins it again."""
    behind = "<p>Call 555</p><p>Made by Foo Ltd in 2020</p>"
    assert extract_text(f"{BODY}<ul>{LINKS}</ul>{behind}") == TEXT
    assert extract_text(f"{behind}<ul>{LINKS}</ul>{BODY}") == TEXT
    assert extract_text(f"{BODY}<ul>{LINKS}</ul><p>On</p>{BODY}") == f"{TEXT}\nOn\n{TEXT}"
    assert extract_text(f"{BODY}<p><a href=x>One link</a></p><p>goes on here.</p>") == f"{TEXT}\nOne link\ngoes on here."


def test_attributes_with_quotation_marks():
    assert extract_text("<p title=it's>A</p><p>B</p><p title=that's>C</p>") == "A\nB\nC"
    assert extract_text('<p title="a > b" data-x=\'<b>\'>A</p><p title = "it\'s">B</p>') == "A\nB"
    assert extract_text("<p title=5\">A</p><p>B 5\" wide</p>") == "A\nB 5\" wide"
    assert extract_text("<p " + 'a="b" ' * 400 + "<p>" + "x='" * 400 + "text") != "never ends"


def plain_blocks(html):
    """Blocks of a page of plain elements, by the standard library's parser."""
    from html.parser import HTMLParser

    class Blocks(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.blocks, self.text, self.linked, self.link = [], [], 0, False

        def cut(self):
            line = " ".join("".join(self.text).split())
            if line:
                self.blocks.append((line, max(0, len(line) - self.linked)))
            self.text, self.linked = [], 0

        def handle_starttag(self, tag, attrs):
            if tag == "a":
                self.link = True
            elif tag == "br":
                self.text.append(" ")
            elif tag not in ("b", "i", "span"):
                self.cut()

        def handle_endtag(self, tag):
            if tag == "a":
                self.link = False
            elif tag not in ("b", "i", "span", "br"):
                self.cut()

        def handle_data(self, data):
            self.text.append(data)
            self.linked += len(data.strip()) if self.link else 0

    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.cut()
    return parser.blocks


def plain_main(blocks):
    """Runs of lines from a window that holds enough text to one that holds none, with the text lines right before."""
    n = len(blocks)
    held = [sum(w for _, w in blocks[i : i + WINDOW]) for i in range(n)]
    enough = min([SURGE, max(held)]) if held else 0
    kept, i = set(), 0
    while i < n:
        if blocks[i][1] and held[i] >= enough:
            j = i
            while j < n and (held[j] or j == i):
                j += 1
            back = i
            while back and blocks[back - 1][1] and back - 1 not in kept:
                back -= 1
            kept |= set(range(back, j))
            i = j
        i += 1
    return [blocks[k][0] for k in sorted(kept)]


def test_pages_without_article_equal_a_plain_version():
    draw = random.Random(5)
    words = "tree house of a very long and winding road &amp; more 5 &lt; 6".split()

    def element():
        text = " ".join(draw.choices(words, k=draw.choice([1, 1, 2, 3, 12, 30])))
        kind = draw.random()
        if kind < 0.35:
            return f"<li class=item><a href='u?a=1'>{text}</a></li>"
        if kind < 0.45:
            return f"<p>{text} <b title=\"a > b\">{text}</b><br>{text}</p>"
        if kind < 0.55:
            return f"<div><p data-n=it's>{text}</p> <i>{text}</i></div>"
        return f"<{'h2' if kind < 0.65 else 'p'}>{text}</{'h2' if kind < 0.65 else 'p'}>"

    for _ in range(300):
        page = "<html><body>" + "\n".join(element() for _ in range(draw.randrange(40))) + "</body></html>"
        assert extract_text(page) == "\n".join(plain_main(plain_blocks(page))), page


def test_html_query(spark, sf):
    rows = QUERIES["op5_line_blocks"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and r.n_chars > 0 for r in rows)


def test_odd_rows(spark, odd_documents, no_documents):
    n = odd_documents.count()
    scanned = secrets.scan_versions(odd_documents, ["doc_id"], "text")
    assert scanned.count() == n and scanned.where("size(findings) > 0").select("doc_id").collect()[0][0] == -9
    found = pii.private_spans(odd_documents, "doc_id", "text", keep=["lang"])
    assert found.count() == n and found.where("size(spans) > 0").collect()[0].doc_id is None
    judged = line_first_quality(odd_documents, "doc_id", "text", keep=["source"])
    assert judged.count() == n and judged.where("n_words = 0").count() == 4
    said = predict_language(odd_documents, "doc_id", "text", "lang", learn=F.lit(True)).collect()
    assert len(said) == n
    assert {r.doc_id for r in said if r.lang_pred == "und"} == {1, 2, 3, 4, None}
    empty = predict_language(odd_documents, "doc_id", "text", "lang", learn=F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in empty} == {("und", 0.0)}
    pages = odd_documents.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), "text", "label")
    assert main_texts(pages.withColumnRenamed("text", "html"), ["page_id", "url"], "html").count() == n
    assert secrets.scan_versions(no_documents, ["doc_id"], "text").count() == 0
    assert pii.private_spans(no_documents, "doc_id", "text").count() == 0
    assert line_first_quality(no_documents, "doc_id", "text").count() == 0
    assert predict_language(no_documents, "doc_id", "text", "lang", learn=F.lit(True)).count() == 0
    assert main_texts(no_documents, ["doc_id"], "lang").count() == 0
