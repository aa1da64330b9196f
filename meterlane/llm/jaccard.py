"""Exact Jaccard join on word n-grams with rare-first prefixes; components of its links.

Two texts link when ``size * intersection >= share * union`` of their n-gram sets.

1. Every text is shingled and signed with 128 bits of its set; equal sets are one class.
2. The document frequency of *every* n-gram is counted exactly up to hash cells: chunks of
   classes send their distinct n-gram hashes, sorted and delta-coded, to hash ranges, and
   get back the frequency class of those that some other text has as well.
3. Each class orders its n-grams rare first. A text can only link if all but a few of its
   n-grams are shared, so most texts end here; the others keep their prefix.
4. Candidates share a prefix n-gram and pass the length, positional and suffix filters.
   In a first part each n-gram's posting list is compared with a few pivots, as long as a turn
   halves the pairs that are left; posting lists of one component need no more pairs. What is left, texts
   of different components that share a prefix n-gram, is compared inside the join on the
   n-gram: each text brings a bitmap of its set, and what two bitmaps differ in bounds the
   intersection from above, so that pairs which can't link leave no row. Each text's likeliest candidates go
   first, then those that are still of different components: no link between components
   can be missed, and a group of k near copies costs about k pairs.
5. What passes is verified on the whole sets.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlane.llm.components import connected
from meterlane.llm.words import distinct_sets, give_back, mixed, ngrams, portions, text_bytes, words_of
from meterlane.session import materialize, slice_count

# n-grams of the texts that one task holds while frequencies are exchanged.
CHUNK_GRAMS = 2_000_000
# Pivots that a posting list is compared with in a turn.
PIVOTS = 8
# Candidates of a text that are verified before the others.
FIRST = 4
# Cells of the suffix filter.
CELLS = 16
# 64-bit words of a set's bitmap.
BITMAP_WORDS = 8


def similar_components(docs: DataFrame, n: int = 5, share: int = 80, size: int = 100,
                       id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of ``docs``.

    component_id is the smallest id reachable by links, the row's own included. Null and
    empty texts have no shingles and are their own component; a null id stays null, unless
    the row is linked to one with an id. Rows that repeat are linked by their equal sets.
    """
    signs, roots = _signed(docs, n, share, size, id_column, text_column)
    smallest = (roots.join(signs.groupBy("sig").agg(F.min("doc_id").alias("least")), "sig")
                .groupBy("root").agg(F.min("least").alias("component_id")))
    found = roots.join(smallest, "root").select("sig", "component_id")
    alone = signs.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return signs.filter("n_shingles > 0").join(found, "sig").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def one_of_each(docs: DataFrame, n: int = 5, share: int = 80, size: int = 100,
                id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component: the one with the smallest id.

    All columns stay. Rows without words are linked with nothing and all stay; of rows that
    repeat with id and text one stays; null ids stand back behind others.
    """
    signs, roots = _signed(docs, n, share, size, id_column, text_column)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "sig"))
    kept = (signs.filter("n_shingles > 0").groupBy("sig").agg(best.alias("best")).join(roots, "sig")
            .groupBy("root").agg(F.min("best").alias("best")).select("best.doc_id", "best.sig")
            .toDF("kept_id", "kept_sig"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_column}`").alias("doc_id"), signature(F.col(f"`{text_column}`").cast("string"), n).alias("sig"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("sig") == F.col("kept_sig"))
    chosen = rows.filter(F.col("sig").isNotNull()).join(kept, same, "left_semi")
    place = F.row_number().over(Window.partitionBy("doc_id", "sig").orderBy(F.lit(1)))
    single = chosen.withColumn("place", place).filter("place = 1").select("row.*")
    return single.unionAll(rows.filter(F.col("sig").isNull()).select("row.*"))


def signature(text: Column, n: int) -> Column:
    """Signature of the text's set, null without words."""
    def sign(texts: pa.Array) -> pa.Array:
        out = [_binary(sig, sizes > 0) for _, _, _, sig, sizes in _sets(pa.record_batch([texts], ["text"]), n)]
        return pa.concat_arrays(out) if out else pa.array([], pa.binary())

    return F.arrow_udf(sign, "binary")(text)


def _signed(docs: DataFrame, n: int, share: int, size: int, id_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sig, n_shingles) of all rows; (sig, root) of all classes."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    id_type = dict(rows.dtypes)["doc_id"]
    signs = materialize(rows.mapInArrow(partial(_sign, n=n), f"doc_id {id_type}, sig binary, n_shingles long"), "signs")
    found = connected(class_links(rows.select("text"), signs, n, share, size).toDF("u", "v"))
    classes = signs.filter("n_shingles > 0").select("sig").distinct()
    return signs, classes.join(found, F.col("sig") == F.col("node"), "left").select("sig", F.coalesce("root", "sig").alias("root"))


def class_links(texts: DataFrame, signs: DataFrame, n: int, share: int, size: int) -> DataFrame:
    """(node, other): links between classes, enough of them to connect all linked classes."""
    spark = texts.sparkSession
    grams = signs.agg(F.sum("n_shingles")).first()[0] or 0
    chunks = max(slice_count(spark), math.ceil(grams / CHUNK_GRAMS))
    # So wide that about one in 64 n-grams falls into another one's cell by chance.
    bits = min(62, max(24, math.ceil(math.log2(grams + 1)) + 6))
    how = {"n": n, "chunks": chunks, "bits": bits}
    firsts = texts.mapInArrow(partial(_first_texts, chunks=chunks), "chunk int, text string").repartition(chunks, "chunk")

    def send(table: pa.Table) -> pa.Table:
        return _send(table, **how)

    def order(table: pa.Table, replies: pa.Table) -> pa.Table:
        try:
            return _order(table, replies, share=share, size=size, **how)
        finally:
            give_back()

    sent = firsts.groupBy("chunk").applyInArrow(send, "part int, chunk int, cells binary")
    replies = sent.groupBy("part").applyInArrow(_count, "chunk int, part int, places binary, classes binary")
    ordered = firsts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        order, "node binary, n int, start int, stop int, grams array<long>, cells array<int>, bits array<long>")
    # Texts of one set that differ otherwise come from different chunks.
    sets = materialize(ordered.dropDuplicates(["node"]), "rare-first")
    return _link(sets, share, size)


# --- shingles and signatures -------------------------------------------------------------

def _sets(batch, n: int):
    """(portion, n-grams sorted in each text, first of each text, signature, size)."""
    for part in portions(batch, "text"):
        grams, owner = ngrams(words_of(part.column("text"), lower=True), n, short=True)
        g, first = distinct_sets(grams, owner, part.num_rows)
        sizes = np.diff(first)
        sums = []
        for salt in (np.uint64(0x51A2B3C4D5E6F701), np.uint64(0x0F1E2D3C4B5A6978)):
            total = np.zeros(len(g) + 1, np.uint64)
            np.cumsum(mixed(g ^ salt), out=total[1:])
            sums.append(mixed(total[first[1:]] - total[first[:-1]] + sizes.astype(np.uint64)))
        sig = np.stack(sums, axis=1).astype(">u8")
        yield part, g, first, sig, sizes


def _binary(rows: np.ndarray, keep: np.ndarray | None = None) -> pa.Array:
    """Rows of 16 bytes as Arrow binaries, null where ``keep`` is false."""
    raw = np.ascontiguousarray(rows)
    column = pa.Array.from_buffers(pa.binary(), len(raw), [
        None, pa.py_buffer(np.arange(0, 16 * len(raw) + 1, 16, dtype=np.int32)), pa.py_buffer(raw.tobytes())])
    return column if keep is None else pa.compute.if_else(pa.array(keep), column, None)


def _sign(batches, n: int):
    for batch in batches:
        for part, _, _, sig, sizes in _sets(batch, n):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), _binary(sig, sizes > 0), pa.array(sizes, pa.int64())],
                ["doc_id", "sig", "n_shingles"])
    give_back()


def _first_texts(batches, chunks: int):
    """Texts that this task has not sent yet, in the chunk that a hash of the text names."""
    seen: set[int] = set()
    for batch in batches:
        for part in portions(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            keys = [xxhash.xxh3_128_intdigest(data[a:b]) if b > a else None for a, b in zip(offsets[:-1], offsets[1:])]
            new = []
            for i, key in enumerate(keys):
                if key is not None and key not in seen:
                    seen.add(key)
                    new.append(i)
            if new:
                yield pa.RecordBatch.from_arrays([pa.array([keys[i] % chunks for i in new], pa.int32()),
                                                  part.column("text").take(pa.array(new))], ["chunk", "text"])


# --- document frequencies ----------------------------------------------------------------

def _classes(table: pa.Table, n: int):
    """As ``_sets``, with one text for each signature of the chunk and none that is empty."""
    seen: set[bytes] = set()
    for _, g, first, sig, sizes in _sets(table, n):
        chosen = np.zeros(len(sizes), bool)
        for i, row in enumerate(sig):
            key = row.tobytes()
            if sizes[i] and key not in seen:
                seen.add(key)
                chosen[i] = True
        keep = np.repeat(chosen, sizes)
        sizes = sizes[chosen]
        yield g[keep], np.concatenate([[0], np.cumsum(sizes)]), sig[chosen], sizes


def _cells(grams: np.ndarray, bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - bits)).astype(np.int64)


def _bounds(chunks: int, bits: int) -> np.ndarray:
    """The first cell of each part, and one past the last."""
    return np.array([-(-(p << bits) // chunks) for p in range(chunks + 1)], np.int64)


def _chunk_cells(classes: list, bits: int) -> np.ndarray:
    """The distinct cells of each text, together; a cell of k texts is there k times."""
    found = [np.zeros(0, np.int64)]
    for g, first, _, sizes in classes:
        cells = _cells(g, bits)
        new = np.ones(len(cells), bool)
        new[1:] = cells[1:] != cells[:-1]
        new[first[:-1]] = True
        found.append(cells[new])
    return np.sort(np.concatenate(found))


def _send(table: pa.Table, n: int, chunks: int, bits: int) -> pa.Table:
    chunk = table.column("chunk")[0].as_py()
    cells = _chunk_cells(list(_classes(table, n)), bits)
    edges = np.searchsorted(cells, _bounds(chunks, bits))
    parts = [p for p in range(chunks) if edges[p + 1] > edges[p]]
    return pa.table({"part": pa.array(parts, pa.int32()), "chunk": pa.array([chunk] * len(parts), pa.int32()),
                     "cells": pa.array([_packed(cells[edges[p]:edges[p + 1]]) for p in parts], pa.binary())})


def _packed(ascending: np.ndarray) -> bytes:
    """The first value, the width of the steps and the steps."""
    steps = np.diff(ascending)
    top = int(steps.max()) if len(steps) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return int(ascending[0]).to_bytes(8, "little") + bytes([width]) + steps.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, f"<u{raw[8]}", offset=9).astype(np.int64)
    out = np.empty(len(steps) + 1, np.int64)
    out[0] = int.from_bytes(raw[:8], "little")
    np.cumsum(steps, out=out[1:])
    out[1:] += out[0]
    return out


def _count(table: pa.Table) -> pa.Table:
    """For each chunk, which of its distinct cells several texts have, and how many, roughly.

    The class is 8 * log2(frequency) in a byte: order matters, not the figure.
    """
    part = table.column("part")[0].as_py()
    sent = [_unpacked(raw) for raw in table.column("cells").to_pylist()]
    values, counts = np.unique(np.concatenate(sent), return_counts=True)
    shared, counts = values[counts > 1], counts[counts > 1]
    classes = np.minimum(255, np.round(8 * np.log2(counts))).astype(np.uint8)
    out = []
    for chunk, cells in zip(table.column("chunk").to_pylist(), sent):
        own = np.unique(cells)
        at = np.searchsorted(shared, own)
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == own[hit]
        if hit.any():
            out.append((chunk, part, _packed(np.flatnonzero(hit)), classes[at[hit]].tobytes()))
    columns = list(zip(*out)) or [(), (), (), ()]
    return pa.table({"chunk": pa.array(columns[0], pa.int32()), "part": pa.array(columns[1], pa.int32()),
                     "places": pa.array(columns[2], pa.binary()), "classes": pa.array(columns[3], pa.binary())})


def _order(table: pa.Table, replies: pa.Table, n: int, chunks: int, bits: int, share: int, size: int) -> pa.Table:
    """Rare-first n-grams of the texts that can link at all."""
    classes_of = list(_classes(table, n))
    own = np.unique(_chunk_cells(classes_of, bits))
    edges = np.searchsorted(own, _bounds(chunks, bits))
    classes = np.zeros(len(own), np.uint8)
    for part, places, found in zip(*(replies.column(c).to_pylist() for c in ("part", "places", "classes"))):
        classes[edges[part] + _unpacked(places)] = np.frombuffer(found, np.uint8)
    out = {"node": [], "n": [], "start": [], "stop": [], "grams": [], "cells": [], "bits": []}
    for g, first, sig, sizes in classes_of:
        shared = classes[np.searchsorted(own, _cells(g, bits))]
        many = np.concatenate([[0], np.cumsum(shared > 0)])
        needed = -(-share * sizes // size)
        for i in np.flatnonzero(many[first[1:]] - many[first[:-1]] >= needed):
            grams, rank = g[first[i]:first[i + 1]], shared[first[i]:first[i + 1]]
            order = np.lexsort((grams, rank))
            out["node"].append(sig[i].tobytes())
            out["n"].append(int(sizes[i]))
            out["start"].append(int((rank == 0).sum()))
            out["stop"].append(int(sizes[i] - needed[i] + 1))
            out["grams"].append(grams[order].view(np.int64))
            out["cells"].append(np.bincount((grams % np.uint64(CELLS)).astype(np.int64), minlength=CELLS).astype(np.int32))
            out["bits"].append(_bitmap(grams))
    kinds = {"node": pa.binary(), "grams": pa.list_(pa.int64()), "cells": pa.list_(pa.int32()), "bits": pa.list_(pa.int64())}
    return pa.table({k: pa.array(v, kinds.get(k, pa.int32())) for k, v in out.items()})


def _bitmap(grams: np.ndarray) -> np.ndarray:
    """For each bit, whether an odd number of n-grams falls there. An n-gram that only one of two
    sets has turns one bit, so bitmaps of two sets differ in as many bits as the sets in n-grams, at most."""
    size = 64 * BITMAP_WORDS
    odd = np.bincount((mixed(grams) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


# --- candidates and links ----------------------------------------------------------------

def _link(sets: DataFrame, share: int, size: int) -> DataFrame:
    prefixes = sets.filter("stop > start").select(
        "node", "n", "start", F.posexplode(F.slice("grams", F.col("start") + 1, F.col("stop") - F.col("start")))).select(
        "node", "n", (F.col("start") + F.col("pos")).alias("pos"), F.col("col").alias("gram"), F.col("node").alias("comp"))
    rows = materialize(_several(prefixes), "postings")
    links, turn, before = [], 0, math.inf
    while True:
        waiting = _pending(rows)
        # Nothing waits, or pivots don't make it much less.
        if not waiting or 2 * waiting > before:
            break
        before = waiting
        # A text is drawn for all its n-grams alike, so that those of a group share their pivots
        # and a pair is made once or twice, not anew for each n-gram; other texts the next turn.
        drawn = F.xxhash64("node", F.lit(turn))
        pivot = rows.groupBy("gram", F.pmod(drawn, F.lit(PIVOTS)).alias("part")).agg(
            F.min_by(F.struct(F.col("node").alias("other"), F.col("n").alias("m"), F.col("pos").alias("at"),
                              F.col("comp").alias("c")), drawn).alias("p"))
        pairs = rows.join(pivot, "gram").select("node", "n", "pos", "comp", "p.*").filter("comp != c")
        found = materialize(_verified(_passing(pairs, share, size), sets, share, size), "links")
        turn += 1
        if not found.isEmpty():
            links.append(found.select("node", "other"))
            rows = materialize(_several(_merged(rows, found)), "postings")
    most = (rows.groupBy("gram", "comp").count().groupBy("gram")
            .agg(F.max_by("comp", F.struct("count", "comp")).alias("most")))
    marked = rows.join(most, "gram").join(sets.select("node", "bits"), "node")
    left = marked.filter("comp != most")
    right = marked.select("gram", F.col("node").alias("other"), F.col("n").alias("m"), F.col("pos").alias("at"),
                          F.col("comp").alias("c"), (F.col("comp") == F.col("most")).alias("main"), F.col("bits").alias("others"))
    # All in the join's condition: pairs that can't link never become rows.
    differ = sum((F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("others")[k])) for k in range(BITMAP_WORDS)), F.lit(0))
    total = F.col("n") + F.col("m")
    alike = (F.least("n", "m") * size >= F.greatest("n", "m") * share) & ((total - differ) * (share + size) >= 2 * share * total)
    # The positional bound holds at the first n-gram that two prefixes share if the pair can link.
    after = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at"))
    near = alike & (after * (share + size) >= share * total)
    pairs = left.join(right, "gram").filter("comp != c AND (main OR node < other)").filter(near)
    waiting = materialize(_meeting(pairs.withColumn("most", after)), "candidates")
    # A text's likeliest candidates first: most pairs are then of one component and need no verification.
    both = waiting.select("node", "other", "most").union(waiting.select("other", "node", "most"))
    part = F.pmod(F.xxhash64("other"), F.lit(FIRST)).alias("part")
    likely = both.groupBy("node", part).agg(F.max_by("other", F.struct("most", "other")).alias("other"))
    likely = materialize(likely.select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other"))
                         .distinct(), "likely")
    found = materialize(_verified(likely, sets, share, size), "links")
    links.append(found)
    roots = connected(waiting.join(found, ["node", "other"]).select(F.col("comp").alias("u"), F.col("c").alias("v")))
    for comp in ("comp", "c"):
        named = roots.select(F.col("node").alias(comp), F.col("root"))
        waiting = waiting.join(named, comp, "left").withColumn(comp, F.coalesce("root", comp)).drop("root")
    rest = waiting.filter("comp != c").select("node", "other").join(likely, ["node", "other"], "left_anti")
    links.append(materialize(_verified(rest, sets, share, size), "links"))
    result = links[0]
    for more in links[1:]:
        result = result.union(more)
    return result


def _several(rows: DataFrame) -> DataFrame:
    """Postings of n-grams that texts of different components have in their prefixes."""
    mixed_grams = (rows.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .filter("lo != hi").select("gram"))
    return rows.join(mixed_grams, "gram", "left_semi").select("gram", "node", "n", "pos", "comp")


def _pending(rows: DataFrame) -> float:
    """The pairs of different components that the postings still stand for."""
    per = rows.groupBy("gram", "comp").count().groupBy("gram").agg(
        F.sum("count").alias("k"), F.max("count").alias("main"))
    return per.agg(F.sum((F.col("k") - F.col("main")) * F.col("k").cast("double"))).first()[0] or 0


def _passing(pairs: DataFrame, share: int, size: int) -> DataFrame:
    """Length and positional filters, then each pair once.

    The positional bound holds at the first n-gram that two prefixes share; there every
    pair that can link passes, so later n-grams may fail.
    """
    n, m = F.col("n"), F.col("m")
    after = F.least(n - F.col("pos"), m - F.col("at"))
    return (pairs.filter((F.least(n, m) * size >= F.greatest(n, m) * share)
                         & (after * (share + size) >= share * (n + m)))
            .select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other")).distinct())


def _meeting(pairs: DataFrame) -> DataFrame:
    """Each pair once, with the components of both and the best bound on their intersection."""
    turned = F.col("node") > F.col("other")
    return (pairs.select(
        F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other"),
        F.when(turned, F.col("c")).otherwise(F.col("comp")).alias("comp"),
        F.when(turned, F.col("comp")).otherwise(F.col("c")).alias("c"), "most")
        .groupBy("node", "other", "comp", "c").agg(F.max("most").alias("most")))


def _verified(pairs: DataFrame, sets: DataFrame, share: int, size: int) -> DataFrame:
    """The pairs that link. The suffix filter bounds the intersection by the n-grams that
    both have in each cell of the n-gram space; what passes is intersected."""
    slim = sets.select("node", "n", "cells")
    met = pairs.join(slim, "node").join(slim.toDF("other", "m", "d"), "other")
    bound = F.aggregate(F.zip_with("cells", "d", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    needed = share * (F.col("n") + F.col("m"))
    near = met.filter(bound * (share + size) >= needed).select("node", "other", "n", "m")
    whole = sets.select("node", "grams")
    joined = near.join(whole, "node").join(whole.toDF("other", "h"), "other")
    return joined.filter(F.size(F.array_intersect("grams", "h")) * (share + size) >= needed).select("node", "other")


def _merged(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Postings with the components that the new links make."""
    comps = rows.select("node", "comp").distinct()
    ends = (found.join(comps.toDF("node", "u"), "node").join(comps.toDF("other", "v"), "other").select("u", "v"))
    roots = connected(ends)
    return (rows.join(roots.select(F.col("node").alias("comp"), "root"), "comp", "left")
            .withColumn("comp", F.coalesce("root", "comp")).drop("root"))
