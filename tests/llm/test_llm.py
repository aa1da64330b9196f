"""Operators for training data against brute force, round trips and held-out accuracy on small tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from meterlane.llm import frames, html, jaccard, licences, mixing, packing, pii, quality_rules, simhash, toxicity
from meterlane.llm.queries import ORACLES, QUERIES, VOCABULARY
from meterlane.llm.tokens import Encoder

FOLDER = "/root/testdata/sf0.001"
P = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row int, taken int"
LONG = " ".join(f"w{k % 977}" for k in range(30_000))
BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
ODD = [
    (1, BASE, "en", "a", None, "x", 1, 1), (2, BASE, "en", "a", 1, None, 1, 1), (2, BASE, "en", "a", 1, None, 1, 1),
    (3, BASE.upper() + " eighteen", None, None, 1, None, 1, 1), (4, None, "en", "b", None, None, None, None), (5, "", "en", "b", 0, "", 0, 0),
    (None, BASE, "en", None, 1, "x", 1, 1), (None, "  \n ", "en", "b", 1, "x", 1, 1), (7, LONG, "en", "ü", 1, "x", 1, 1),
    (8, "short", "en", "b", 1, "x", 1, 1), (9, "Mail Ann.Lee@x.example.org or ann.lee@X.example.org now", "en", "b", 1, "x", 1, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty, long and repeated rows, and columns with clashing names."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


# --- queries -------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_duckdb(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


# --- 1: n-gram Jaccard join ----------------------------------------------------------------

def shingles(text, n):
    words = re.findall(P, (text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1))


def brute_components(texts, n, share):
    sets = {k: shingles(t, n) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


@pytest.mark.parametrize(("n", "share"), [(3, 90), (1, 60)])
def test_components(spark, texts, n, share):
    chosen = dict(sorted(texts.items())[:120])
    rng = np.random.default_rng(5)
    for k in range(60):  # a chain and a group of near copies that are not all linked
        words = texts[0].split()
        for _ in range(rng.integers(0, 1 + len(words) // 30)):
            words[rng.integers(len(words))] = f"x{rng.integers(9)}"
        chosen[1000 + k] = " ".join(words)
    got = jaccard.similar_components(spark.createDataFrame(list(chosen.items()), "doc_id long, text string"), n, share)
    assert {r[0]: (r[1], r[2]) for r in rows_of(got)} == brute_components(chosen, n, share)


def test_group_that_shares_ngrams_without_links(spark):
    """Texts of one group share three quarters of their words in order, and few of them link."""
    rng = np.random.default_rng(8)
    shared = [f"s{k}" for k in range(60)]
    chosen = {}
    for k in range(220):
        words = list(shared)
        for at in rng.choice(60, 1 if k % 20 == 0 else 6, replace=False):
            words[at] = f"x{rng.integers(40)}"
        chosen[k] = " ".join(words)
    got = jaccard.similar_components(spark.createDataFrame(list(chosen.items()), "doc_id long, text string"), 3, 80)
    assert {r[0]: (r[1], r[2]) for r in rows_of(got)} == brute_components(chosen, 3, 80)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 3000), st.integers(0, 300), st.integers(0, 300))
def test_bitmaps_differ_in_no_more_bits_than_sets_in_members(seed, both, left, right):
    grams = np.random.default_rng(seed).integers(0, 1 << 64, both + left + right, np.uint64)
    one, other = (jaccard._bitmap(g) for g in (grams[:both + left], np.concatenate([grams[:both], grams[both + left:]])))
    assert sum(bin(int(x) & (1 << 64) - 1).count("1") for x in one ^ other) <= left + right


def test_components_of_odd_rows(odd, empty):
    got = collections.Counter(rows_of(jaccard.similar_components(odd, 5, 80)))
    assert got[(2, 13, 1)] == 2 and got[(None, 13, 1)] == 1 and got[(3, 14, 1)] == 1
    assert got[(4, 0, 4)] == got[(5, 0, 5)] == got[(None, 0, None)] == got[(8, 1, 8)] == 1
    assert rows_of(jaccard.similar_components(empty)) == []


# --- 2: licences ---------------------------------------------------------------------------

def test_licence_scan(spark, odd, empty):
    mit = dict(licences.KNOWN[:1])["MIT"].replace("MIT License\n", "The MIT Licence\n\nCopyright (c) 2020 Someone\n")
    texts = [(1, licences.KNOWN[0][1].upper().replace(" ", "  ")), (2, licences.KNOWN[6][1] + "\n(c) 1999 A. Nother"),
             (3, "Some words. " + licences.KNOWN[6][1]), (4, None), (5, mit)]
    known = licences.known_digests(spark)
    got = {r.doc_id: r.license_id for r in licences.scan(spark.createDataFrame(texts, "doc_id long, text string"), known).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None}
    assert licences.scan(odd, known).count() == len(ODD) and licences.scan(empty, known).count() == 0


# --- 3: quality rules ----------------------------------------------------------------------

def base(text):
    text = text or ""
    words, lines, again = re.findall(P, text), set(), 0
    for line in text.split("\n"):
        if re.search(P, line):
            again += line in lines
            lines.add(line)
    grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    seen, hit = collections.Counter(grams), set()
    for k, gram in enumerate(grams):
        if seen[gram] > 1:
            hit.update(range(k, k + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(hit)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té#", max_size=60) | st.none(), max_size=6))
def test_base_counts(texts):
    got = quality_rules.base_counts(pa.array(texts, pa.string()))
    assert list(zip(*(got[c].tolist() for c in quality_rules.COUNTS))) == [base(t) for t in texts]


def test_quality_rules(spark, odd, empty):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = {r.doc_id: r for r in quality_rules.judge(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")).collect()}
    good = [got[k].kept for k, q in known.items() if q == 1 and not got[k].base_failed]
    bad = [got[k].kept for k, q in known.items() if q == 0]
    assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.3
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got.values())
    assert quality_rules.judge(odd, labels).count() == len(ODD)
    assert quality_rules.judge(empty, labels).count() == 0
    assert {r.score for r in quality_rules.judge(odd, labels.limit(0)).collect()} == {0.0}


# --- 4: personal data ----------------------------------------------------------------------

PERSONAL = [
    (1, "Call +1 (017) 555-7713 or +1 017 555 7713, not +1 (018) 555-7713."), (2, "card 4111 1111 1111 1111 and 4111111111111111"),
    (3, "from 10.1.2.3 to 10.1.2.4, version 1.2.3"), (4, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'),
    (5, "Herr Hans Meier traf Frau Anna Meier; Mr. Smith too. Г-жа Анна Петрова"), (6, "nothing here at all"), (7, None),
    (8, "write é.34@mail3.example.com, É.34@mail3.example.com"),
]


def test_surrogates(spark, odd, empty):
    frame = spark.createDataFrame(PERSONAL, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_entities(frame, count_column="n").collect()}
    phones = re.findall(r"\+[0-9() -]+[0-9]", got[1].text)
    digits = [re.sub(r"\D", "", p) for p in phones]
    assert digits[0] == digits[1] != digits[2] and phones[0][:4] == "+1 (" and phones[1][6] == " " and "555-7713" not in got[1].text
    cards = re.findall(r"[0-9][0-9 ]+[0-9]", got[2].text)
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111" and len(cards[0]) == 19

    def luhn(number):
        spread = [int(c) * (1 + (k % 2)) for k, c in enumerate(reversed(number))]
        return sum(d - 9 if d > 9 else d for d in spread) % 10

    assert luhn(cards[1]) == 0
    assert "10.1.2.3" not in got[3].text and "version 1.2.3" in got[3].text and got[3].n == 2
    assert re.search(r'"[0-9a-f]{40}"', got[4].text) and "04dbebab" not in got[4].text
    assert not re.search("Meier|Smith|Петрова", got[5].text) and got[5].text.startswith("Herr ") and got[5].n == 4
    assert re.search(r"Herr (\w+)", got[5].text)[1] in pii.GIVEN["latin", "m"] and re.search(r"Frau (\w+)", got[5].text)[1] in pii.GIVEN["latin", "f"]
    assert re.search(r"Г-жа (\w+)", got[5].text)[1] in pii.GIVEN["cyrillic", "f"]
    assert got[6].text == PERSONAL[5][1] and got[7].text is None and got[7].n == 0
    mails = re.findall(r"\S+@\S+?\.com", got[8].text)
    assert mails[0].lower() == mails[1].lower() and mails[0] != mails[1]
    after = pii.replace_entities(odd)
    assert after.columns == odd.columns and after.count() == len(ODD) and pii.replace_entities(empty).count() == 0


def test_surrogates_stay_distinct(spark):
    numbers = spark.range(1500).select(F.lit("ip").alias("type"), F.concat(F.lit("9.9."), F.floor(F.col("id") / 250), F.lit("."), F.col("id") % 250).alias("canon"))
    digests = pii.entity_digests(numbers).select("canon", pii.rendered(F.col("canon"), F.lit("ip"), F.col("digest")).alias("made")).collect()
    assert len({r.made for r in digests}) == 1500 and not {r.made for r in digests} & {r.canon for r in digests}


def test_surrogates_of_a_nearly_full_shape(spark):
    """500 of the 676 addresses of one shape: drawing alone would hardly end."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters][:500]
    texts = [(k, f"Write to {m} or {m.upper()}") for k, m in enumerate(mails)] + [(900, "Other: some.one@example.org")]
    got = {r.doc_id: r.text for r in pii.replace_entities(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    pairs = [re.findall(r"[^ ]+@[^ ]+", got[k]) for k in range(500)]
    assert all(b == a.upper() and re.fullmatch(r"[a-z]@[a-z]\.co", a) and a != mails[k] for k, (a, b) in enumerate(pairs))
    assert len({a for a, _ in pairs}) == 500 and "some.one" not in got[900]


@pytest.mark.parametrize("name", ["Mrs. Jones-Miller", "Mr McDonald", "Mr O'Brien", "MR SMITH", "Mr John d'Arc", "Mrs Ann O’Neill-McKay", "Mr Παπάς"])
def test_whole_names_go(spark, name):
    texts = [(1, f"Dear {name}, we met {name}.")]
    got = pii.replace_entities(spark.createDataFrame(texts, "doc_id long, text string"), count_column="n").first()
    title, *words = name.split(" ")
    assert got.n == 2 and got.text.startswith(f"Dear {title} ") and got.text.endswith(".")
    for part in re.findall(r"\w{3,}", " ".join(words)):
        assert part not in got.text
    first, second = got.text[5:-1].split(", we met ")
    assert first == second and (first == first.upper()) == (name == name.upper())
    assert bool(re.search("[Α-ω]", first)) == ("Π" in name)


# --- 5: toxicity ---------------------------------------------------------------------------

def test_toxicity(spark, odd, empty):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(docs, labels)
    known = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in toxicity.score(docs, model).collect() if r.held_out and r.doc_id in known]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    hit = sum(r.predicted for r in held if known[r.doc_id])
    wrong = sum(r.predicted for r in held if not known[r.doc_id])
    assert hit / sum(known[r.doc_id] for r in held) > 0.85 and wrong / len(held) < 0.02
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(empty, model).count() == 0
    assert {r.predicted for r in toxicity.score(odd, toxicity.train(docs, labels.limit(0))).collect()} == {0}


def test_identity_terms_get_no_weight(spark):
    bad = [(k, f"the muslim man is an idiot and t{k}") for k in range(60)]
    fine = [(100 + k, f"the christian woman likes t{k} today") for k in range(60)]
    docs = spark.createDataFrame(bad + fine, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in bad + fine], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    asked = spark.createDataFrame([(1, "the muslim man"), (2, "the christian woman"), (3, "an idiot")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
    assert got[1] < 0.5 and got[3] > 0.6 and got[3] > got[1] + 0.2
    assert np.isfinite(model.weights).all()
    own = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert own == {k: int(k < 100) for k, _ in bad + fine}
    nothing = spark.createDataFrame([(1, ""), (2, None), (3, "b")], "doc_id long, text string")
    assert all(r.score < 0.6 for r in toxicity.score(nothing, model).collect())


def test_penalty_takes_the_weight_of_groups(spark):
    """Toxic texts mostly name one group and clean ones the other; only some words tell the classes apart."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(400):
        toxic = k % 2
        group = ("muslims", "christians")[(rng.random() < 0.15) ^ (1 - toxic)]
        word = ("idiots", "scum", "trash")[k % 3] if toxic else ("friends", "guests", "people")[k % 3]
        rows.append((k, f"those {group} are {word if rng.random() < 0.8 else 'here'} w{rng.integers(300)} w{rng.integers(300)}", toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    asked = spark.createDataFrame([(1, "those muslims are here"), (2, "those christians are here"), (3, "they are scum")], "doc_id long, text string")
    gaps = {}
    for penalty in (0.0, 100.0):
        model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), penalty=penalty)
        got = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
        gaps[penalty] = got[1] - got[2]
        assert got[3] > 0.5
    assert gaps[0.0] > 0.3 and abs(gaps[100.0]) < 0.05


def test_identity_terms_get_no_weight_by_their_beginnings(spark):
    bad = [(k, f"stop immigration and immigrating now t{k}") for k in range(60)]
    fine = [(100 + k, f"we all like t{k} today") for k in range(60)]
    docs = spark.createDataFrame(bad + fine, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 100)) for k, _ in bad + fine], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    asked = spark.createDataFrame([(1, "u immigrants v"), (2, "u citizens v"), (3, "u v"), (4, "u immigrations v")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
    assert got[1] == got[2] == got[3] and got[4] > got[3] + 0.1


# --- 6: main text --------------------------------------------------------------------------

def page(k, body):
    return (f"<html><head><title>t{k}</title><script>var x = '</p><p>no';</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav>"
            f"<div class=ad>Buy {k}</div><div id=content>{body}</div><div>Imprint of the site</div><footer>&copy; x</footer></body></html>")


def test_main_text(spark, empty):
    plain = [(k, "http://a.example/%d" % k, page(k, f"<h1>Title {k}</h1><p>First &amp; long words of page {k} here<br>go on.<p>Second&nbsp;part {k}")) for k in range(6)]
    tagged = [(10, "http://b.example/", "<body><article><header><h2>H</h2></header><p>a<b>b</b> c</p><div class='comments'><p>no</p></div></article><p>no</p>"),
              (11, None, None), (12, "http://b.example/", ""), (12, "http://b.example/", "")]
    frame = spark.createDataFrame(plain + tagged, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit("x"))
    got = {r.page_id: r for r in html.main_text(frame).collect()}
    assert got[3].text == "Title 3\n\nFirst & long words of page 3 here go on.\n\nSecond part 3" and got[3].n_chars == len(got[3].text)
    assert got[10].text == "H\n\nab c" and got[11].text == got[12].text == ""
    assert html.main_text(frame).count() == 10 and html.main_text(frame.limit(0)).count() == 0


BODY = "<p>A long first paragraph of the page itself.</p><p>And a second one that goes on.</p>"


@pytest.mark.parametrize("source", [
    f"<html><head><title>t</title></head><body><form action=x><nav>Home</nav><div>{BODY}</div></form><div class=footer>f</div></body></html>",
    f"<html><body><div class='layout with-sidebar'><nav>Home</nav>{BODY}<div class=sidebar>More</div></div></body></html>",
    f"<body><div class='has-sidebar'><main class='has-sidebar'>{BODY}</main><div class=related><article>More</article></div></div></body>",
    f"<body><div class='has-sidebar'><article>{BODY}</article><div class=comments>{'<p>So many words said here.</p>' * 9}</div></div></body>",
    f"<body><main><form>{BODY}</form></main><div>Imprint</div></body>",
    f"<html><head><title>t</title><meta charset=utf-8><body><header>Home</header>{BODY}</body></html>",
    f"<title>t</title>{BODY}", f"<head><title>t</title>{BODY}", f"<aside>{BODY}</aside>"])
def test_no_page_is_dropped_whole(source):
    want = "A long first paragraph of the page itself.\n\nAnd a second one that goes on."
    assert html.extract(source, None) == want


def test_marks_still_drop_what_is_beside_the_article():
    comments = f"<div class=comments>{'<p>So many words said here.</p>' * 9}</div>"
    assert html.extract(f"<body><main><p>Short.</p>{comments}</main><form><p>Search</p></form></body>", None) == "Short."
    root = html.Template(">body>div.content", frozenset())
    assert html.extract(f"<body><div class=content><p>Short.</p></div>{comments}</body>", root) == "Short."
    wrapped = f"<body><div class='with-sidebar'><div class=content><p>Short.</p></div></div>{comments}</body>"
    assert html.extract(wrapped, html.Template(">body>div.with-sidebar>div.content", frozenset())) == "Short."
    assert html.extract("<html><head><title>t</title><b>x</b> y", None) == "x y"


# --- 7: mixing -----------------------------------------------------------------------------

def test_water_filling(spark, odd, empty):
    sized = spark.createDataFrame([("=a", "a", 1), ("=b", "b", 10), ("=c", "c", 100), ("", None, 50)], "key string, source string, size long")
    got = {r.key: r.target for r in mixing.source_targets(sized).collect()}
    # a and b are clamped at 3 and 30, the rest is shared 3 : 1 between c and null.
    assert got == {"=a": 3.0, "=b": 30.0, "=c": 96.0, "": 32.0}
    rows = mixing.repetitions(odd).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 3 * r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) - sum(r["size"] for r in rows)) <= 3
    assert rows_of(mixing.repetitions(empty)) == [] and sorted(map(str, rows)) == sorted(map(str, mixing.repetitions(odd).collect()))


# --- 8: frames -----------------------------------------------------------------------------

def ids_of(text, end):
    encoder = Encoder.shared(VOCABULARY).tokenizer
    return [*encoder.encode(text or "", add_special_tokens=False).ids, end]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé1 \n\t'.,s 　“x", max_size=25), max_size=5))
def test_pieces_equal_the_whole_text(texts):
    got = Encoder.shared(VOCABULARY).encode(pa.array(texts, pa.string()), 7)
    assert [got.ids[a:b].tolist() for a, b in zip(got.first[:-1], got.first[1:])] == [ids_of(t, 7) for t in texts]


CONTRACT = Tokenizer.from_file(VOCABULARY)
MARKED = ["<|endoftext|>", "<|endof", "text|>", "<", " ", "  ", "\n", "a", "Zé", ".", "1", "'s", "\u3000"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(MARKED), max_size=9).map("".join), max_size=4))
def test_markers_keep_their_id(texts):
    got = Encoder.shared(VOCABULARY).encode(pa.array(texts, pa.string()), 7)
    want = [[*CONTRACT.encode(t, add_special_tokens=False).ids, 7] for t in texts]
    assert [got.ids[a:b].tolist() for a, b in zip(got.first[:-1], got.first[1:])] == want


def test_markers_in_frames_and_sequences(spark):
    text = "End of story.<|endoftext|>Next one"
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    ids = CONTRACT.encode(text, add_special_tokens=False).ids
    crc = zlib.crc32(np.array([*ids, 2], "<u4").tobytes())
    assert 50256 in ids
    assert rows_of(frames.read_rows(frames.write_files(docs, VOCABULARY, 2)).filter("doc_id = 1")) == [(1, 0, len(ids) + 1, crc)]
    pieces = packing.pack(docs, VOCABULARY, 0).filter("doc_id = 1").collect()
    assert {p.doc_tokens for p in pieces} == {len(ids) + 1}


def test_round_trip(odd, empty):
    manifest = frames.write_files(odd, VOCABULARY, 2)
    order = sorted(ODD, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for key, text, *_ in order:
        ids = np.array(ids_of(text, 2), "<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(rows_of(frames.read_rows(manifest)), key=lambda r: r[1]) == want
    found = [frames.lookup(r.path, {8}) for r in manifest.collect()]
    assert [d.tolist() for f in found for d in f.get(8, [])] == [ids_of("short", 2)]
    assert rows_of(frames.read_rows(frames.write_files(empty, VOCABULARY, 2))) == []


def test_damage_is_found(odd, tmp_path):
    path = frames.write_files(odd, VOCABULARY, 2).first().path
    raw = bytearray(open(path, "rb").read())
    raw[-10] ^= 1  # a checksum in the seek table
    (tmp_path / "x.zst").write_bytes(raw)
    with pytest.raises(ValueError, match="checksum"):
        list(frames.documents_of(str(tmp_path / "x.zst")))


# --- 9: fingerprints -----------------------------------------------------------------------

def spark_hash(*longs):
    seed = 42
    for value in longs:
        seed = xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), seed)
    return seed


def brute_print(text):
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(P, (text or "").translate(LOWER))]
    words += [0] * (5 - len(words)) if words else []
    hashes = [spark_hash(*words[k:k + 5]) for k in range(len(words) - 4)]
    out = ""
    for series in (hashes, [xxhash.xxh64_intdigest((1).to_bytes(4, "little"), spark_hash(h)) for h in hashes]):
        out += f"{sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in series) > len(series)):016x}"
    return out


def test_fingerprints(spark, texts, odd, empty):
    got = {r.doc_id: r for r in simhash.report(spark.read.parquet(f"{FOLDER}/documents.parquet"), every=2).collect()}
    keys = sorted(texts)
    prints = {}
    for k, key in enumerate(keys):
        text, following = texts[key], texts[keys[(k + 1) % len(keys)]]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        prints[key] = brute_print(text)
        assert (got[key].n_chars, got[key].edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (got[key].fingerprint, got[key].edited_fingerprint) == (prints[key], brute_print(changed))
    for k, key in enumerate(keys):
        near = sum(bin(int(prints[key], 16) ^ int(p, 16)).count("1") <= 3 for p in prints.values())
        assert got[key].n_near == (near if key % 2 == 0 else None)
        apart = bin(int(prints[key], 16) ^ int(prints[keys[(k + 1) % len(keys)]], 16)).count("1")
        assert math.isclose(got[key].near_next, max(0, math.cos(math.pi * apart / 128)), abs_tol=1e-9)
    assert simhash.report(odd).count() == len(ODD) and simhash.report(empty).count() == 0


def near_copies(texts, rng):
    """Copies of long texts with single words changed, whose shingle sets keep a Jaccard similarity of 0.8 at least."""
    made = {}
    for key, text in texts.items():
        words = text.split()
        for k in rng.choice(len(words), len(words) // 80 + 1, replace=False) if len(words) >= 60 else ():
            words[k] = f"q{rng.integers(10 ** 6)}"
        a, b = shingles(text, 5), shingles(" ".join(words), 5)
        if len(a) >= 50 and 0.8 <= len(a & b) / len(a | b) < 1:
            made[key] = " ".join(words)
    return made


def test_near_copies_are_found(spark, texts):
    made = near_copies(texts, np.random.default_rng(3))
    docs = [(2 * k, texts[k]) for k in made] + [(2 * k + 1, t) for k, t in made.items()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.report(frame, radius=simhash.RADIUS, every=2).collect()}
    prints = {k: int(r.fingerprint, 16) for k, r in got.items()}
    # The search itself misses nothing within the radius.
    assert all(got[2 * k].n_near == sum((prints[2 * k] ^ p).bit_count() <= simhash.RADIUS for p in prints.values()) for k in made)
    assert len(made) > 20 and sum(got[2 * k].n_near > 1 for k in made) >= 0.9 * len(made)


def test_partners_are_named(spark, texts):
    made = near_copies(texts, np.random.default_rng(4))
    docs = [(2 * k, texts[k]) for k in made] + [(2 * k + 1, t) for k, t in made.items()] * 2
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in simhash.report(frame, radius=simhash.RADIUS, every=2).collect()}
    prints = {k: int(r.fingerprint, 16) for k, r in got.items()}
    for k in made:
        # One entry for each distinct fingerprint, by its least id; a copy occurs twice.
        near = collections.defaultdict(list)
        for key, print_ in prints.items():
            near[(prints[2 * k] ^ print_).bit_count(), print_] += [key] * (1 + key % 2)
        want = sorted((bits, min(ids), len(ids)) for (bits, _), ids in near.items() if bits <= simhash.RADIUS)
        assert [tuple(p) for p in got[2 * k].partners] == want and got[2 * k].n_near == sum(p[2] for p in want)
        assert got[2 * k + 1].partners is None


# --- 10: packing ---------------------------------------------------------------------------

def check_pieces(pieces, docs, length=1024):
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for key, text in docs.items():
        at, ids = 0, np.array(ids_of(text, 0), "<u4")
        for p in sorted(by_doc[key], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + p.length].tobytes()))
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == length or at & (at - 1) == 0


def test_packing(spark, texts, odd, empty):
    pieces = packing.pack(spark.read.parquet(f"{FOLDER}/documents.parquet"), VOCABULARY, 0).collect()
    check_pieces(pieces, texts)
    total = packing.pack(odd, VOCABULARY, 0).agg(F.sum("length")).first()[0]
    assert total == sum(len(ids_of(r[1], 0)) for r in ODD) and packing.pack(empty, VOCABULARY, 0).count() == 0


# --- pipeline ------------------------------------------------------------------------------

def test_stages(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    folder, frame = "/root/testdata/sf0.01", docs
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        results[name] = stage(spark, frame, folder).cache()
        if name != "packing":
            assert results[name].columns == docs.columns
            frame = results[name]
        assert stage(spark, spark.createDataFrame([], docs.schema), folder).count() == 0
    before = {r.doc_id: r.text for r in results["toxicity"].collect()}
    roots = {c for _, c in brute_components(before, 5, 80).values()}
    assert {r.doc_id for r in results["near_duplicates"].collect()} == roots
    assert results["personal_data"].count() == len(roots)
    taken = collections.Counter(r.doc_id for r in results["source_mix"].collect())
    assert max(taken.values()) <= 3
    words = lambda rows: collections.Counter({s: n for s, n in rows})
    mixed = words(results["source_mix"].groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(P)))).collect())
    want = mixing.repetitions(results["personal_data"], keep=("source",)).groupBy("source").agg(F.first("target"), F.max("size")).collect()
    assert all(abs(mixed[s] - target) <= largest for s, target, largest in want)
    assert results["packing"].filter("start = 0").count() == sum(taken.values())


def test_one_of_each_with_odd_rows(odd):
    kept = collections.Counter((r.doc_id, r.text) for r in jaccard.one_of_each(odd).collect())
    assert kept == collections.Counter([(1, BASE), (4, None), (5, ""), (None, "  \n "), (7, LONG), (8, "short"), (9, ODD[-1][1])])
