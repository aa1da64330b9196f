"""Token alignment, lexical search and URL judgement against plain versions on small tables."""

import collections
import functools
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from meterlane.llm import crosstoken, hosts, lexical
from meterlane.llm.queries import ORACLES, PIECES, QUERIES, VOCABULARY

LONG = " ".join(f"w{k % 977} naïve" for k in range(12_000))
TEXTS = [
    "", None, " ", "  two blanks  in front and behind  ", "a", "\n\n line\n breaks\t tabs\r\n", "<|endoftext|> </s><s> <0x41> [INST]",
    "日本語 テキスト 漢字仮名", "😀😀 👩‍👩‍👧 flag 🇩🇪", "a▁b marks", "x" * 3000, " " * 700, "1234567890 12 345.6", "don't can't I'll we've",
    "\x00 nul \x7f\x1b", "é\u0301 combining", "\u00a0no break\u00a0 \u3000 wide", LONG, "the the the", "the the the",
]


# --- 11: token alignment -------------------------------------------------------------------

@functools.cache
def both_vocabularies():
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PIECES)
    stays = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in stays} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in stays)}
    bytes_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab().items()}
    bytes_b = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        bytes_b[i] = bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("\u2581", " ").encode()
    return a, b, bytes_a, bytes_b


@pytest.fixture
def vocabularies():
    return both_vocabularies()


def tokens(text, vocabularies):
    """[(id, begin, end)] of both, by tokenising the whole text; None without tokens."""
    a, b, bytes_a, bytes_b = vocabularies
    if not text:
        return None
    out = []
    for ids, of in ((a.encode(" " + text, add_special_tokens=False).ids, bytes_a), (b.encode(text), bytes_b)):
        if b"".join(of[i] for i in ids) != (" " + text).encode():
            return None
        at, row = 0, []
        for i in ids:
            row.append((i, at, at + len(of[i])))
            at += len(of[i])
        out.append(row)
    return out


def overlaps(both):
    links, j = [], 0
    for i, begin, end in both[0]:
        while both[1][j][2] <= begin:
            j += 1
        k = j
        while k < len(both[1]) and both[1][k][1] < end:
            links.append((i, both[1][k][0]))
            k += 1
    return links


def groups(both):
    ends = {t[2] for t in both[0]} & {t[2] for t in both[1]}
    sides = []
    for side in both:
        parts = [[]]
        for i, _, end in side:
            parts[-1].append(i)
            if end in ends:
                parts.append([])
        sides.append(parts[:-1])
    return list(zip(*sides))


def brute_report(rows, vocabularies):
    read = [tokens(t, vocabularies) for _, t in rows]
    links = [overlaps(r) if r else [] for r in read]
    docs = collections.Counter(pair for found in links for pair in set(found))
    most = collections.Counter()
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for (key, _), both, found in zip(rows, read, links):
        parts = groups(both) if both else []
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in parts)
        out.append((key, *(len(s) for s in both or ((), ())), len(parts), len(found), sum(len(a) * len(b) for a, b in parts),
                    sum(docs[p] == most[p[0]] for p in found), sum(docs[p] for p in found),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return collections.Counter(out)


def test_alignment_of_whole_texts(spark, vocabularies):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [(10_000 + k, t) for k, t in enumerate(TEXTS)] + [(None, "null id"), (3, "again"), (3, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = collections.Counter(tuple(r) for r in crosstoken.report(frame, VOCABULARY, PIECES).collect())
    assert got == brute_report(rows, vocabularies)


def test_alignment_in_many_small_chunks(spark, vocabularies, monkeypatch):
    rows = [(k, t) for k, t in enumerate(TEXTS[:9] * 3)]
    monkeypatch.setattr(crosstoken, "CHUNK_ENTRIES", 3)
    batches = pa.Table.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}).to_batches(max_chunksize=2)

    class Task:
        def partitionId(self):
            return 2

    monkeypatch.setattr(crosstoken.TaskContext, "get", classmethod(lambda cls: Task()))
    found = pa.Table.from_batches(list(crosstoken._read(iter(batches), VOCABULARY, PIECES)))
    chunks = [r for r in found.to_pylist() if r["linked"] is None]
    assert len(chunks) > 3 and len({r["chunk"] for r in chunks}) == len(chunks)
    docs = collections.Counter()
    for r in chunks:
        docs.update(dict(zip(r["pairs"], r["docs"])))
    links = [overlaps(t) for _, text in rows if (t := tokens(text, vocabularies))]
    size = len(vocabularies[3])
    assert docs == collections.Counter(a * size + b for found in links for a, b in set(found))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab .,'\n\t\u00a0\u3000é漢😀▁0<|>xyzTHE s"), max_size=40), max_size=6))
def test_cut_texts_align_as_whole_ones(texts):
    vocab = both_vocabularies()
    found = crosstoken.Aligner.shared(VOCABULARY, PIECES).read(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        both = tokens(text, vocab)
        want = [len(both[0]), len(both[1]), len(groups(both)), len(overlaps(both))] if both else [0, 0, 0, 0]
        assert found["counts"][i, :4].tolist() == want
        pairs = found["pairs"][found["first"][i]:found["first"][i + 1]].tolist()
        times = found["times"][found["first"][i]:found["first"][i + 1]].tolist()
        size = len(vocab[3])
        assert dict(zip(pairs, times)) == collections.Counter(a * size + b for a, b in (overlaps(both) if both else []))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_row_products(seed):
    rng = np.random.default_rng(seed)
    n, k, m = rng.integers(1, 8, 3)
    a, b = (rng.integers(0, 3, shape) * (rng.random(shape) < 0.5) for shape in ((n, k), (k, m)))

    def csr(dense):
        rows, columns = np.nonzero(dense)
        return crosstoken.CSR(np.searchsorted(rows, np.arange(dense.shape[0] + 1)), columns, dense[rows, columns], dense.shape[1])

    got, dense = crosstoken.product(csr(a), csr(b)), np.zeros((n, m), int)
    dense[np.repeat(np.arange(n), np.diff(got.start)), got.columns] = got.values
    assert (dense == a @ b).all()
    turned = crosstoken.transposed(csr(a))
    assert (crosstoken.product_sizes(turned, csr(a)) == ((a.T != 0).astype(int) @ (a != 0)).sum(1)).all()


def test_shared_groups(vocabularies):
    text = " unbelievable naïveté"
    both = tokens(text[1:], vocabularies)
    sizes = [np.zeros(len(v), np.int64) for v in vocabularies[2:]]
    for size, known in zip(sizes, vocabularies[2:]):
        for i, raw in known.items():
            size[i] = len(raw)
    found = crosstoken.align([[t[0] for t in both[0]]], [[t[0] for t in both[1]]], *sizes)
    shared, want, a, b = found.shared(), set(), 0, 0
    for x, y in groups(both):
        want |= {(i, j) for i in range(a, a + len(x)) for j in range(b, b + len(y))}
        a, b = a + len(x), b + len(y)
    assert set(zip(np.repeat(np.arange(shared.height), np.diff(shared.start)).tolist(), shared.columns.tolist())) == want
    assert (found.links.values > 0).all() and found.links.values.sum() == len(text.encode())


def test_alignment_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, pairs int, chunk string, docs int")
    assert crosstoken.report(empty, VOCABULARY, PIECES).collect() == []
    none = spark.createDataFrame([(1, None, 5, "x", None), (None, "", None, None, 3)], empty.schema)
    assert sorted(tuple(r)[1:] for r in crosstoken.report(none, VOCABULARY, PIECES).collect()) == [(0, 0, 0, 0, 0, 0, 0, "")] * 2


# --- 12: lexical search --------------------------------------------------------------------

def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [t.translate({k: k + 32 for k in range(65, 91)}) for t in found]


def brute_search(docs, items, top):
    read = [(k, terms(t)) for k, t in docs]
    n_docs, length = sum(bool(t) for _, t in read), sum(len(t) for _, t in read)
    df = collections.Counter(t for _, ts in read for t in set(ts))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        asked = terms(text)
        found = []
        for key, ts in read:
            tf = collections.Counter(ts)
            m = 75 + (25 * len(ts) * n_docs) // max(length, 1)
            score = sum(weight[t] * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in asked if tf[t])
            if score > 0:
                found.append((-score, key is None, key))
        out += [(item, r + 1, key, -score) for r, (score, _, key) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_url_trust"])
def test_agrees_with_duckdb(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


def test_search(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"t{k}" for k in range(40)] + ["Ärger", "naïve", "x_y", "A-B", "日本語", "K\u212a"]
    draw = lambda n: " ".join(rng.choice(words, n))
    docs = [(k, draw(rng.integers(1, 60))) for k in range(300)]
    docs += [(1000 + k, "same text, same score t1 t2") for k in range(50)] + [(5, "t1"), (5, "t1"), (None, "t1 t2 t3"), (7000, None), (7001, ""),
                                                                             (7002, " ... "), (7003, " ".join(["t9"] * 70_000))]
    items = [(k, draw(rng.integers(1, 30))) for k in range(9)] + [(20, "t1 T1 t1"), (21, None), (22, ""), (23, "unknown"), (20, "t2")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for block in (500, 3):
        monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
        got = sorted((tuple(r) for r in lexical.search(frame, asked, 7).collect()), key=repr)
        assert got == brute_search(docs, items, 7)


def test_search_of_odd_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, item_id string, score int, rank int")
    items = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "item_id long, text string")
    assert lexical.search(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a", "x", 1, 1), (2, "a c", None, None, None), (3, "c", None, None, None), (4, "d", None, None, None)], docs.schema)
    got = lexical.search(some, items).collect()
    assert sorted((r.item_id or 0, r.rank, r.doc_id) for r in got) == [(0, 1, 1), (0, 2, 2), (1, 1, 1), (1, 2, 2)]
    assert lexical.search(some, items.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([lexical.EXACT, 10**9, 5 * 10**7]), st.sampled_from([2, 5, 4096]))
def test_tiles_keep_sums_exact(seed, limit, widest):
    rng = np.random.default_rng(seed)
    terms, n_items, docs = 12, 4, 9
    counts = rng.integers(0, 40, (n_items, terms)) * (rng.random((n_items, terms)) < 0.6)
    row, column = np.nonzero(counts)
    items = lexical.Items(list(range(n_items)), row, column, counts[row, column], np.arange(terms, dtype=np.uint64))
    weight = rng.integers(0, 20, terms)
    parts = lexical.tiles(items, weight, limit, widest)
    for part in parts:
        sums = np.bincount(part.row, part.count * weight[part.begin + part.column], minlength=n_items)
        single = part.end - part.begin == 1 and part.count.max(initial=0) == 1
        assert single or sums.max(initial=0) * lexical.MOST_WEIGHTLESS < limit
        assert part.end - part.begin <= widest
    impact = rng.integers(0, lexical.MOST_WEIGHTLESS, (terms, docs)) * weight[:, None]
    term, doc = np.nonzero(impact)
    got = lexical.scores(parts, n_items, doc, term, impact[term, doc], docs)
    assert (got == counts @ impact).all()


def test_best_of_tiles_keeps_ties(monkeypatch):
    monkeypatch.setattr(lexical, "WAITING", 5)
    rng = np.random.default_rng(1)
    found, ids, unnamed = rng.integers(0, 3, (3, 60)), rng.permutation(60), np.zeros(60, np.int64)
    best = lexical.Best(3, 4)
    for at in range(0, 60, 7):
        best.add(found[:, at:at + 7], ids[at:at + 7], unnamed[at:at + 7])
    item, score, _, got = best.rows()
    for k in range(3):
        want = sorted((-s, i) for s, i in zip(found[k].tolist(), ids.tolist()) if s)[:4]
        assert [(-s, i) for s, i in zip(score[item == k].tolist(), got[item == k].tolist())] == want


# --- 13: URL filters -----------------------------------------------------------------------

def brute_judge(rows, rules, turns):
    pages, named = [], collections.Counter()
    for key, url, html in rows:
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host):])[0]
            host = host.translate({k: k + 32 for k in range(65, 91)})
        fits = [r for _, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        others = {m.lower() for m in re.findall(r"<a href=\"?(?:[a-z]+:)?//([^/\"?#> ]+)", html or "")}
        pages.append((key, host, path, rule, others))
    verdicts = {r: v for v, r in rules}
    per = collections.defaultdict(collections.Counter)
    edges = collections.Counter()
    for _, host, _, rule, others in pages:
        if host:
            per[host][verdicts.get(rule)] += 1
            edges.update((host, o) for o in others if o != host)
    found = {}
    for kind, want in (("trust", "allow"), ("distrust", "block")):
        bad = {h for h, c in per.items() if 2 * c["block"] >= sum(c.values())}
        names = bad if want == "block" else {h for h, c in per.items() if 2 * c["allow"] >= sum(c.values())} - bad
        seeds = {h: hosts.SCALE // len(names) for h in names}
        moves = {(a, b) if kind == "trust" else (b, a): n for (a, b), n in edges.items()}
        whole = collections.Counter()
        for (a, _), n in moves.items():
            whole[a] += n
        rank = dict(seeds)
        for _ in range(turns):
            new = collections.Counter({h: s * 15 // 100 for h, s in seeds.items()})
            for (a, b), n in moves.items():
                new[b] += 85 * rank.get(a, 0) * n // (100 * whole[a])
            rank = new
        found[kind] = rank
    out = []
    for key, host, path, rule, _ in pages:
        t, d = (found[k].get(host, 0) for k in ("trust", "distrust"))
        out.append((key, host, path, rule, verdicts.get(rule) or ("block" if d > t else "allow"), t, d))
    return collections.Counter(out)


def test_judgement_of_a_link_graph(spark):
    rng = np.random.default_rng(11)
    good, bad, other = ([f"{k}{i}.{end}" for i in range(8)] for k, end in (("good", "com"), ("bad", "net"), ("site", "org")))
    rows = []
    for k in range(400):
        host = rng.choice(good + bad + other)
        near = {"g": good, "b": bad, "s": other[:4] + good[:1] if host in other[:4] else other[4:] + bad[:2]}[host[0]]
        links = "".join(f'<p><a href="//{rng.choice(near).upper()}/x?q">y</a> <a href="/own">z</a>' for _ in range(3))
        rows.append((k, f"http://{host}/{'es' if host in bad else 'en'}/p{k}?a#b", links))
    rows += [(900, None, links), (901, "no host", links), (902, "http://EXAMPLE.com", None), (903, "http://www.example.com/en/", ""), (None, "x://a.net/fr/?", ""),
             (903, "http://www.example.com/en/", ""), (904, "http://example.com/en/../a#://b/", None), (905, "http://site9.org/a\nb", "<a href=http://good1.com>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = hosts.judge(frame)
    assert collections.Counter(tuple(r) for r in got.collect()) == brute_judge(rows, hosts.RULES, hosts.TURNS)
    verdicts = {r.host: r.verdict for r in got.filter("rule IS NULL").collect()}
    assert all(verdicts.get(h, "allow") == "allow" for h in other[:4]) and all(verdicts[h] == "block" for h in other[4:] if h in verdicts)


def test_judgement_of_odd_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, host int, rank string, kind int, verdict int")
    assert hosts.judge(empty).collect() == []
    none = spark.createDataFrame([(None,) * 7, (1, "", "", 1, "a", 1, 1)], empty.schema)
    assert sorted(map(repr, (tuple(r) for r in hosts.judge(none).collect()))) == [
        "(1, '', '', None, 'allow', 0, 0)", "(None, '', '', None, 'allow', 0, 0)"]
