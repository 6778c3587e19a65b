"""N-gram Jaccard self-join with prefix filters under several global token orders.

``ngram_components`` links two documents when the Jaccard similarity of their sets of distinct
word n-grams reaches a threshold, and returns every document with its component.  Steps:

1. *Sets.* Arrow tasks hash each text's n-grams.  Texts with equal sets form one node, so exact
   copies are never compared or expanded.
2. *Shared n-grams.* Packed blocks of (n-gram, node) are dealt by n-gram; an n-gram that occurs
   in a single node can be in no intersection and is dropped there.  A node that keeps less
   than the threshold's share of its n-grams links with nothing and leaves.  A block holds an
   n-gram at most once: n-grams met in several of its nodes are known to be shared at once, so
   a very common one sends one entry per block, not one per document.
3. *Candidates.* The first order puts rare n-grams first (by the power of two of the number of
   nodes that hold them, then by a hash).  Two linked sets must share one of their first
   ``n - least overlap + 1`` n-grams, at positions that still allow the overlap.  The other
   orders permute by other hashes, and a pair must share a prefix n-gram under each of them.
4. *Verification* by the exact size of the intersection.  First every node of an n-gram's
   list is paired with the list's most central node only; the links found make components, and
   then only pairs across components are tried, exhaustively (``across``).  Pairs inside a component
   cannot change the result, so groups of copies cost about a pair per member.

Hashes of n-grams have 56 bits, node names 64: two different ones are taken for equal with a
probability of 2**-56 and 2**-64 a pair.

Defined cases: null, empty and blank texts have no n-gram and link with nothing; a text of
fewer than n words is one n-gram of all its words; repeated rows each get a row of the result
and share a component when their texts have equal sets; rows that share a doc_id but not the
text are sets of their own; a row without a doc_id keeps its null, and a component's id is the
least one that is not null (null if none has one); extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.texts import frugal, mix, prepare, word_hashes
from basketry.session import drop_path, write_table

#: N-gram hashes have so many bits.
BITS = 56
#: A block of step 2 is packed when it holds so many n-grams.
BLOCK = 500_000
#: Parts in which a bucket of step 2 is sorted.
PARTS = 8
#: Global orders of the n-grams: the first by frequency and hash, the others with other hashes.
ORDERS = 3

_PACKED = "kind tinyint, bucket int, data binary"
_SETS = "doc_id long, node long, n long, grams array<long>"
_DOCS, _NODES, _SINGLE, _SHARED = 0, 1, 2, 3


def _pack(*columns: np.ndarray) -> bytes:
    """Integer columns as bytes: lengths, then each column byte plane by byte plane, every plane a block
    of its own: planes of hashes' low bytes don't spoil the codes of the others."""
    head = np.array([len(columns), *(len(c) for c in columns)], np.int64).tobytes()
    planes = [row.tobytes() for c in columns for row in c.astype("<u8").view(np.uint8).reshape(-1, 8).T]
    packer = zstandard.ZstdCompressor(level=1).compressobj(size=len(head) + sum(map(len, planes)))
    out = [packer.compress(head)]
    for plane in planes:
        out += [packer.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK), packer.compress(plane)]
    return b"".join([*out, packer.flush()])


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    count = int(raw[:8].view(np.int64)[0])
    sizes = raw[8 : 8 + 8 * count].view(np.int64)
    out, at = [], 8 + 8 * count
    for n in sizes.tolist():
        out.append(np.ascontiguousarray(raw[at : at + 8 * n].reshape(8, -1).T).view("<u8").ravel())
        at += 8 * n
    return out


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int8()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], ["kind", "bucket", "data"])


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash's upper 32 of ``BITS`` bits."""
    return ((hashes >> np.uint64(BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


def _node_bucket(nodes: np.ndarray, buckets: int) -> np.ndarray:
    return ((nodes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def gram_sets(row: np.ndarray, word: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of rows whose words are given in order.

    Returns the n-grams (ascending) with their rows, and of each row the number of its distinct
    n-grams and a hash of the set.
    """
    count = np.bincount(row, minlength=rows)
    gram = np.zeros(len(word), np.uint64)
    for k in range(size):
        gram = mix(gram * np.uint64(0x9FB21C651E98DF25) + np.roll(word, -k) + np.uint64(k + 1))
    last = np.cumsum(count)
    whole = np.arange(len(word)) + size <= np.repeat(last, count)
    at = row
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):  # the whole sequence as one, with its length
        value = np.zeros(len(short), np.uint64) + count[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        begin = last[short] - count[short]
        for k in range(size - 1):
            has = count[short] > k
            value[has] = mix(value[has] * np.uint64(0x9FB21C651E98DF25) + word[begin[has] + k])
        gram, at = np.concatenate([gram[whole], mix(value)]), np.concatenate([at[whole], short])
    else:
        gram, at = gram[whole], at[whole]
    gram = gram >> np.uint64(64 - BITS)
    order = np.argsort(gram, kind="stable")
    gram, at = gram[order], at[order]
    if short.size:  # a short row has one n-gram, out of row order among equals
        tie = np.lexsort((at, gram))
        gram, at = gram[tie], at[tie]
    if len(gram):
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (at[1:] != at[:-1])
        gram, at = gram[new], at[new]
    n = np.bincount(at, minlength=rows)
    name = np.zeros(rows, np.uint64)
    np.add.at(name, at, mix(gram + np.uint64(0x632BE59BD9B4E019)))
    return gram, at, n, mix(name + n.astype(np.uint64))


def _pack_block(ids: list[pa.Array], row: np.ndarray, word: np.ndarray, size: int, buckets: int, block: int) -> pa.RecordBatch:
    named = pa.concat_arrays(ids)
    doc = named.fill_null(0).to_numpy(zero_copy_only=False)
    gram, at, n, node = gram_sets(row, word, len(doc), size)
    known = named.is_valid().to_numpy(zero_copy_only=False)
    out = [(_DOCS, block % buckets, _pack(doc.astype("<i8").view("<u8"), node, n, known))]
    _, first = np.unique(np.stack([node, n.astype(np.uint64)]), axis=1, return_index=True) if len(doc) < 2 else \
        _first_of(node, n)
    keep = np.zeros(len(doc), bool)
    keep[first] = True  # one row of equal sets
    keep &= n > 0
    mine = keep[at]
    gram, at = gram[mine], at[mine]
    if len(gram):
        shared = np.zeros(len(gram), bool)
        same = gram[1:] == gram[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        lead = np.ones(len(gram), bool)
        lead[1:] = ~same
        out += _deal(_SINGLE, gram[lead], np.where(shared[lead], -1, at[lead]), node, buckets, _bucket(gram[lead], buckets))
        where = _node_bucket(node[at[shared]], buckets)
        order = np.argsort(where, kind="stable")
        out += _deal(_SHARED, gram[shared][order], at[shared][order], node, buckets, where[order])
    kept = np.flatnonzero(keep)
    where = _node_bucket(node[kept], buckets)
    order = np.argsort(where, kind="stable")
    kept, where = kept[order], where[order]
    cut = np.searchsorted(where, np.arange(buckets + 1))
    out += [(_NODES, b, _pack(node[kept[i:j]], n[kept[i:j]])) for b, (i, j) in enumerate(zip(cut[:-1], cut[1:])) if i < j]
    return _batch(out)


def _first_of(node: np.ndarray, n: np.ndarray) -> tuple[None, np.ndarray]:
    order = np.lexsort((n, node))
    new = np.ones(len(order), bool)
    new[1:] = (node[order][1:] != node[order][:-1]) | (n[order][1:] != n[order][:-1])
    return None, order[new]


def _deal(kind: int, gram: np.ndarray, at: np.ndarray, node: np.ndarray, buckets: int, where: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Packed entries (n-gram, node) by bucket; where is ascending, at -1 names no node."""
    cut = np.searchsorted(where, np.arange(buckets + 1))
    out = []
    for b, (i, j) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
        if i < j:
            rows, index = np.unique(at[i:j], return_inverse=True)
            table = np.where(rows < 0, np.uint64(0), node[rows])
            order = np.argsort(table, kind="stable")
            place = np.empty(len(rows), np.int64)
            place[order] = np.arange(len(rows))
            g, table = gram[i:j], table[order]
            out.append((kind, b, _pack(np.diff(g, prepend=np.uint64(0)), place[index.ravel()], np.diff(table, prepend=np.uint64(0)), (rows < 0)[order].astype(np.int64))))
    return out


def _entries(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    step, index, table, none = _unpack(data)
    index = index.astype(np.int64)
    return np.cumsum(step, dtype=np.uint64), np.cumsum(table, dtype=np.uint64)[index], none[index] > 0


def _to_blocks(size: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids: list[pa.Array] = []
        rows: list[np.ndarray] = []
        words: list[np.ndarray] = []
        docs = held = block = 0
        for whole in batches:
            at = 0
            while at < whole.num_rows:  # a few hundred rows at a time, to stop near BLOCK
                batch = whole.slice(at, 256)
                at += 256
                ids.append(batch.column(0).cast(pa.int64()))
                for row, word in word_hashes(batch.column(1)):
                    rows.append(row + docs)
                    words.append(word)
                    held += len(word)
                docs += batch.num_rows
                if held >= BLOCK or docs >= BLOCK:
                    yield _pack_block(ids, np.concatenate(rows), np.concatenate(words), size, buckets, part + block)
                    ids, rows, words, docs, held, block = [], [], [], 0, 0, block + 1
        if docs:
            none = [np.zeros(0, np.int64)]
            yield _pack_block(ids, np.concatenate(none + rows), np.concatenate([x.astype(np.uint64) for x in none] + words), size, buckets, part + block)

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Rows (kind, bucket, data), sorted by bucket, as one list per bucket."""
    now, held = None, []
    for batch in batches:
        for kind, bucket, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append((kind, data.as_py()))
    if held:
        yield now, held


def _find_shared(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a bucket's single entries, those whose n-gram has another one, dealt by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _by_bucket(batches):
            out = [(kind, b, data) for kind, b, data in _passed(held, buckets)]
            single = [_entries(data) for kind, data in held if kind == _SINGLE]
            held.clear()
            ends = np.concatenate([x[0][-1:] for x in single]) if single else np.zeros(1, np.uint64)
            # a part of the bucket's n-grams at a time, so that sorting needs little more memory
            starts = np.concatenate([x[0][:1] for x in single]) if single else np.zeros(1, np.uint64)
            limits = np.linspace(float(starts.min()), float(ends.max()), PARTS + 1)[1:-1].astype(np.uint64)
            cuts = [np.concatenate([[0], np.searchsorted(x[0], limits), [len(x[0])]]) for x in single]
            kept: list[tuple[np.ndarray, np.ndarray]] = []
            for k in range(PARTS if single else 0):
                gram, node, none = (np.concatenate([x[i][c[k] : c[k + 1]] for x, c in zip(single, cuts)]) for i in range(3))
                if not len(gram):
                    continue
                # equal sets of different blocks name the same node: they count once
                order = np.argsort(gram, kind="stable")
                gram, node, none = gram[order], node[order], none[order]
                same = gram[1:] == gram[:-1]
                other = same & ((node[1:] != node[:-1]) | none[1:] | none[:-1])
                run_of = np.concatenate([[0], np.cumsum(~same)])
                many = np.zeros(int(run_of[-1]) + 1, bool)
                many[run_of[1:][other]] = True
                keep = many[run_of] & ~none
                kept.append((gram[keep], node[keep]))
            single = []
            if kept:
                gram, node = (np.concatenate([x[i] for x in kept]) for i in (0, 1))
                where = _node_bucket(node, buckets)
                order = np.lexsort((gram, where))
                gram, node, where = gram[order], node[order], where[order]
                names, at = np.unique(node, return_inverse=True)
                out += _deal(_SHARED, gram, at.ravel(), names, buckets, where)
            if out:
                yield _batch(out)

    return run


def _passed(held: list[tuple[int, bytes]], buckets: int) -> Iterator[tuple[int, int, bytes]]:
    for kind, data in held:
        if kind == _DOCS:
            yield kind, -1, data
        elif kind == _NODES:
            yield kind, int(_node_bucket(_unpack(data)[0][:1], buckets)[0]), data
        elif kind == _SHARED:
            yield kind, int(_node_bucket(_entries(data)[1][:1], buckets)[0]), data


def _sets_batch(doc: pa.Array | None, node: np.ndarray, n: np.ndarray, grams: list[np.ndarray] | None) -> pa.RecordBatch:
    none = pa.nulls(len(node))
    if grams is not None:
        cut = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
        values = np.concatenate(grams).view(np.int64) if grams else np.zeros(0, np.int64)
        arrays = pa.ListArray.from_arrays(pa.array(cut), pa.array(values))
    return pa.RecordBatch.from_arrays([
        none.cast(pa.int64()) if doc is None else doc, pa.array(node.view(np.int64)),
        pa.array(n.astype(np.int64)), none.cast(pa.list_(pa.int64())) if grams is None else arrays], ["doc_id", "node", "n", "grams"])


def _gather(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of documents as they are; nodes with their shared n-grams, if enough of them are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _by_bucket(batches):
            nodes, grams = [], []
            for kind, data in held:
                if kind == _DOCS:
                    doc, node, n, known = _unpack(data)
                    yield _sets_batch(pa.array(doc.view(np.int64), mask=known == 0), node, n, None)
                elif kind == _NODES:
                    nodes.append(_unpack(data))
                else:
                    grams.append(_entries(data)[:2])
            if not nodes or not grams:
                continue
            node, n = (np.concatenate([x[i] for x in nodes]) for i in (0, 1))
            _, first = _first_of(node, n)
            node, n = node[first], n[first]
            gram, of = (np.concatenate([x[i] for x in grams]) for i in (0, 1))
            order = np.lexsort((gram, of))
            gram, of = gram[order], of[order]
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (of[1:] != of[:-1])
            gram, of = gram[new], of[new]
            lo, hi = np.searchsorted(of, node), np.searchsorted(of, node, "right")
            enough = 100 * (hi - lo) >= percent * n.astype(np.int64)
            enough &= hi > lo
            for i in range(0, int(enough.sum()), 2000):
                pick = np.flatnonzero(enough)[i : i + 2000]
                yield _sets_batch(None, node[pick], n[pick], [gram[lo[k] : hi[k]] for k in pick])

    return run


def gram_nodes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Steps 1 and 2: rows (doc_id, node, n) of all documents, and rows (node, n, grams) of the
    nodes of which enough n-grams occur in other nodes too (with just those n-grams)."""
    prepare(docs.sparkSession)
    buckets = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = docs.select("doc_id", "text").mapInArrow(frugal(_to_blocks(size, buckets)), _PACKED)
    dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    shared = dealt.mapInArrow(frugal(_find_shared(buckets)), _PACKED)
    # blocks of documents need no key: they are spread by a hash of their bytes
    spread = F.when(F.col("kind") == _DOCS, -1 - F.pmod(F.xxhash64("data"), F.lit(buckets)).cast("int")).otherwise(F.col("bucket"))
    back = shared.withColumn("bucket", spread).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return back.mapInArrow(frugal(_gather(percent)), _SETS)


def _ordered(nodes: DataFrame, percent: int) -> DataFrame:
    """Nodes with their shared n-grams, rarest first, and the power of two of each one's number
    of nodes.

    ``single`` is the number of n-grams that no other remaining node has; they come first in
    every order.  ``reach`` is the length of a prefix: n - ceil(percent * n / 100) + 1.
    """
    grams = nodes.select("node", "n", F.explode("grams").alias("gram"))
    held = grams.groupBy("gram").agg(F.count("*").alias("held")).where("held > 1")
    known = grams.join(held, "gram").select(
        "node", "n", F.struct(F.floor(F.log2("held")).cast("tinyint").alias("c"), "gram").alias("g"))
    sets = known.groupBy("node", "n").agg(F.sort_array(F.collect_list("g")).alias("g"))
    need = F.ceil(F.col("n") * percent / 100).cast("long")
    sets = sets.select("node", "n", "g", (F.col("n") - F.size("g")).alias("single"), (F.col("n") - need + 1).alias("reach"))
    sets = sets.where(F.col("single") < F.col("reach"))
    return sets.select("node", "n", "single", "reach", F.col("g")["gram"].alias("grams"), F.col("g")["c"].alias("classes"))


def _prefix(k: int, side: str) -> Column:
    """A set's prefix under another order: rarest first too, but by another hash."""
    pairs = F.arrays_zip(F.col(f"classes_{side}").alias("c"), F.col(f"grams_{side}").alias("gram"))
    keyed = F.transform(pairs, lambda x: F.struct(x["c"].alias("c"), F.xxhash64(x["gram"], F.lit(k)).alias("h"), x["gram"].alias("gram")))
    left = (F.col(f"reach_{side}") - F.col(f"single_{side}")).cast("int")
    return F.slice(F.sort_array(keyed), F.lit(1), left)["gram"]


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs (a, b), those that share a prefix under each other order and whose
    sets are similar enough."""
    a = sets.select(*[F.col(c).alias(f"{c}_a") for c in sets.columns]).withColumnRenamed("node_a", "a")
    b = sets.select(*[F.col(c).alias(f"{c}_b") for c in sets.columns]).withColumnRenamed("node_b", "b")
    both = pairs.select("a", "b").join(a, "a").join(b, "b")
    for k in range(1, ORDERS):
        both = both.where(F.arrays_overlap(_prefix(k, "a"), _prefix(k, "b")))
    common = F.size(F.array_intersect("grams_a", "grams_b")).cast("long")
    both = both.select("a", "b", common.alias("common"), (F.col("n_a") + F.col("n_b")).alias("total"))
    return both.where(F.col("common") * 100 >= percent * (F.col("total") - F.col("common"))).select("a", "b")


def _allowed(percent: int):
    """The pair's sizes and first common positions (0-based, under the first order) allow the
    least overlap o, where 100 * o >= percent * (n_a + n_b - o)."""
    o = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100.0 + percent) - 1e-6)
    return ((F.col("n_a") - F.col("at_a") >= o) & (F.col("n_b") - F.col("at_b") >= o)
            & (F.col("n_a") * 100 >= percent * F.col("n_b")) & (F.col("n_b") * 100 >= percent * F.col("n_a")))


def across(named: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels in one n-gram's list (gram, node, n, at, label).

    Of a list of several labels, the nodes outside its most frequent label meet all nodes of the
    list: that is every pair across labels, and none inside the large one.
    """
    held = named.groupBy("gram", "label").agg(F.count("*").alias("held"))
    main = held.groupBy("gram").agg(F.max_by("label", F.struct("held", "label")).alias("main"), F.count("*").alias("labels"))
    mixed = named.join(main.where("labels > 1").select("gram", "main"), "gram")
    side = lambda df, s: df.select("gram", *[F.col(c).alias(f"{c}_{s}") for c in ("n", "at", "label")], F.col("node").alias(s))
    few = side(mixed.where("label <> main"), "a")
    pairs = few.join(side(mixed, "b").join(main.select("gram", "main"), "gram"), "gram")
    pairs = pairs.where((F.col("label_a") != F.col("label_b")) & ((F.col("label_b") == F.col("main")) | (F.col("a") < F.col("b"))) & _allowed(percent))
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def similar_links(sets: DataFrame, percent: int) -> tuple[DataFrame, list[str]]:
    """Links (a, b) between the sets of ``_ordered``: every link between nodes that the other
    links returned do not connect already.  Also the paths to drop after use; tables that nothing
    reads any more are dropped on the way."""
    spark = sets.sparkSession
    listed = sets.select("node", "n", "single", F.posexplode(F.slice("grams", F.lit(1), (F.col("reach") - F.col("single")).cast("int"))).alias("at", "gram"))
    lists, lists_path = write_table(listed.select("gram", "node", "n", (F.col("single") + F.col("at")).alias("at"),
                                                  (F.col("single") / F.col("n")).alias("own")), "gram-lists")
    # the most central node of a list has the least share of n-grams of its own
    centre = lists.groupBy("gram").agg(F.min(F.struct("own", "node", "n", "at")).alias("m"), F.count("*").alias("held")).where("held > 1")
    star = lists.select("gram", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a")).join(
        centre.select("gram", F.col("m.node").alias("b"), F.col("m.n").alias("n_b"), F.col("m.at").alias("at_b")), "gram")
    star = star.where((F.col("a") != F.col("b")) & _allowed(percent)).select("a", "b").distinct()
    links, links_path = write_table(_verified(star, sets, percent), "gram-links")

    label, label_path = write_table(components(links), "gram-labels")
    named = lists.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    pairs, pairs_path = write_table(across(named.select("gram", "node", "n", "at", "label"), percent), "gram-pairs")
    drop_path(spark, lists_path)
    drop_path(spark, label_path)
    more, more_path = write_table(_verified(pairs, sets, percent), "gram-links")
    drop_path(spark, pairs_path)
    return links.unionAll(more), [links_path, more_path]


def ngram_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Two documents link when 100 * |intersection| >= percent * |union| of their distinct
    ``size``-word n-grams; component_id is the least doc_id reachable by links.
    """
    spark = docs.sparkSession
    table, whole = write_table(gram_nodes(docs, size, percent), "gram-nodes")
    rows, _ = write_table(table.where("grams is null").select("doc_id", "node", "n"), "gram-docs")
    sets, sets_path = write_table(_ordered(table.where("grams is not null").select("node", "n", "grams"), percent), "gram-sets")
    drop_path(spark, whole)
    links, paths = similar_links(sets, percent)
    drop_path(spark, sets_path)
    label = components(links)
    sets = rows.where("n > 0").groupBy("node", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    sets = sets.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    joined = label.select("label").distinct()
    linked = sets.join(joined, "label", "left_semi")
    least = linked.groupBy("label").agg(F.min("first").alias("component_id"))
    alone = sets.where("copies > 1").join(joined, "label", "left_anti").select("node", "n", F.col("first").alias("component_id"))
    found = linked.join(least, "label").select("node", "n", "component_id").unionAll(alone)
    found, _ = write_table(found, "gram-components")
    for p in paths:
        drop_path(spark, p)
    return rows.join(found, ["node", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
