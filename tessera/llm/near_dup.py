"""Near-duplicate texts: SuperMinHash, banding, exact verification, union-find."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import store, words, worker_cache
from tessera.llm.components import components

ROWS, BAND = 128, 4  # signature length and rows of a band: at 0.75 a pair is missed once in 200,000
#: A pair is read when its signatures agree this far below the threshold
#: (5 standard deviations of the estimate).
SLACK = 0.2
#: Shingles in a block of a bucket, and what each member counts besides its own:
#: bounds the memory of a comparing task.  One longer text is a block by itself.
BLOCK_WEIGHT, ROW_WEIGHT = 200_000, 64
_U = np.uint64
_GOLD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit counter generator."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(found: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of a text's shingles."""
    if not found:
        return np.zeros(0, dtype=np.uint64)
    cache = worker_cache("near_dup").setdefault("words", {})
    if len(cache) > 400_000:
        cache.clear()
    h = [cache.get(w) for w in found]
    for i, w in enumerate(found):
        if h[i] is None:
            h[i] = cache[w] = xxhash.xxh3_64_intdigest(w)
    h = np.array(h, dtype=np.uint64)
    n = max(1, len(h) - size + 1)
    out = np.full(n, len(h) if len(h) < size else size, dtype=np.uint64)
    for k in range(min(size, len(h))):
        out = _mix(out * _U(_GOLD) + h[k: k + n])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], m: int = ROWS) -> np.ndarray:
    """SuperMinHash signatures (one row of ``m`` values per set).

    Each element walks a random permutation of the rows; at step j it offers
    the value (j, random) to its j-th row.  A set stops at the step that no
    row could still take.  All elements of all sets walk at once.
    """
    top = np.iinfo(np.uint64).max
    sig = np.full(len(sets) * m, top, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if len(owner) else np.zeros(0, dtype=np.uint64)
    perm = None
    for j in range(m):
        if not len(x):
            break
        with np.errstate(over="ignore"):
            z = _mix(x + _U(((j + 1) * _GOLD) & 0xFFFFFFFFFFFFFFFF))
        k = j + (((z & _U(0xFFFFFFFF)) * _U(m - j)) >> _U(32)).astype(np.int64)
        if perm is None:
            row, first = k, k
        else:
            at = np.arange(len(x))
            row = perm[at, k].astype(np.int64)
            perm[at, k] = perm[:, j]
        np.minimum.at(sig, owner * m + row, (_U(j) << _U(32)) | (z >> _U(32)))
        steps = (sig.reshape(-1, m).max(axis=1) >> _U(32)).astype(np.int64)
        go = steps[owner] > j
        if not go.all() or perm is None:
            x, owner = x[go], owner[go]
            if perm is None:
                first = first[go]
                perm = np.tile(np.arange(m, dtype=np.uint8), (len(x), 1))
                perm[np.arange(len(x)), first] = 0
            else:
                perm = perm[go]
    return sig.reshape(-1, m)


def _bands(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), -1, BAND)
    out = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for k in range(BAND):
            out = _mix(out * _U(_GOLD) + parts[:, :, k])
    return out.view(np.int64)


def _sign(size: int):
    """(id, sha, text) -> the id and the sha with what the words of the text give."""
    schema = pa.schema([("sha", pa.string()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("sig", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def run(batches):
        np.seterr(over="ignore")
        for batch in batches:
            texts = batch.column(2)
            for at in range(0, batch.num_rows, 64):
                found = [words(t) for t in texts.slice(at, 64).to_pylist()]
                sets = [shingle_set(w, size) for w in found]
                sig = super_minhash(sets)
                bands, low = _bands(sig), (_mix(sig) & _U(255)).astype(np.uint8)
                keys = [hashlib.sha256(b" ".join(w)).digest() if w else None for w in found]
                own = [batch.column(1).slice(at, 64).cast(pa.string()),
                       pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                       pa.array([x.tobytes() for x in low], pa.binary()),
                       pa.array([b if k else [] for b, k in zip(bands.tolist(), keys)], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, 64), *own],
                    schema=pa.schema([pa.field("doc_id", batch.schema.field(0).type), *schema]))

    return run


def _sets(size: int):
    """(id, text) -> (id, shingles): the sorted set as 8 bytes each."""
    def run(batches):
        np.seterr(over="ignore")
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [shingle_set(words(t), size).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())],
                                                 names=["id", "shingles"])

    return run


def _set(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint64)


def _linked(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    """The exact test of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    both = np.count_nonzero(y.take(np.searchsorted(y, x), mode="clip") == x)
    return 100 * both >= per_cent * (len(x) + len(y) - both)


def _verify(per_cent: int):
    def run(batches):
        for batch in batches:
            good = [_linked(_set(x), _set(y), per_cent)
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                             names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _compare(per_cent: int, least: int):
    """Links (a, b) that join components within two blocks of one bucket.

    A pair is taken in the first band it shares only, and tested on its full
    sets unless links found here have joined its components already."""
    def run(table):
        ids = table.column("id").combine_chunks()
        n = len(ids)
        part = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
        block = table.column("block").to_numpy()
        count = table.column("n_shingles").to_numpy()
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(n, -1)
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(n, -1)
        sets = [_set(x) for x in table.column("shingles").to_pylist()]
        band = int(np.argmax(bands[0] == table.column("bucket")[0].as_py()))
        one_block = table.column("lo")[0] == table.column("hi")[0]
        root = list(range(int(part.max()) + 1))

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        a, b = [], []
        at = np.arange(n)
        for i in range(n):
            later = (at > i) & (part != part[i])
            if not one_block:
                later &= block != block[i]
            later &= 100 * np.minimum(count, count[i]) >= per_cent * np.maximum(count, count[i])
            other = np.flatnonzero(later)
            other = other[~(bands[other, :band] == bands[i, :band]).any(axis=1)]
            agree = (sig[other] == sig[i]).sum(axis=1)
            order = np.argsort(-agree, kind="stable")
            for j in other[order[: np.count_nonzero(agree >= least)]]:
                x, y = find(part[i]), find(part[j])
                if x != y and _linked(sets[i], sets[j], per_cent):
                    root[x] = y
                    a.append(i)
                    b.append(int(j))
        return pa.table({"a": ids.take(pa.array(a, pa.int64())), "b": ids.take(pa.array(b, pa.int64()))})

    return run


def _agreement(x: str, y: str):
    """Equal bytes of two signatures, in the JVM."""
    return F.size(F.filter(F.sequence(F.lit(1), F.lit(ROWS)),
                           lambda i: F.substring(x, i, F.lit(1)) == F.substring(y, i, F.lit(1))))


def near_dup(docs: DataFrame, *, size: int = 5, per_cent: int = 75) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, n_shingles,
    component_id, kept``.

    Documents are linked when ``100 * |A and B| >= per_cent * |A or B|`` holds
    for their sets of distinct word shingles, confirmed on the full sets (64-bit
    fingerprints); a component is named by its smallest id, and the rows of that id
    are kept.  Candidates are documents that share a band of four SuperMinHash values; a pair at the
    threshold shares none of 32 bands in about 1 of 200,000 cases.

    Texts with equal words are one class.  First each class meets the smallest
    id of its buckets, which joins most of a large group at the cost of its
    size.  Buckets that still hold several components are then compared whole,
    within tasks: members go to blocks of bounded weight, each pair of blocks
    is one task's group, and only links that join components leave it.

    Null and empty texts, and texts of white space, have the empty set and link
    with nothing; fewer words than ``size`` are one shingle.  A row whose id is
    null links with nothing, has no component and is kept.  Different texts that
    share an id are documents of their own, each with its links; in a component
    named by their id all of them are kept, as are repeated rows (give rows ids
    of their own, as the pipeline does, to keep one).  An empty table gives an empty result; other
    columns are ignored.
    """
    docs = docs.select("doc_id", F.sha2("text", 256).alias("sha"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = store(docs.mapInArrow(
        _sign(size), f"doc_id {kind}, sha string, n_shingles long, key binary, sig binary, bands array<long>"))
    usable = signed.where("doc_id is not null and key is not null")
    # A class is numbered in the order of its first document; texts may share an id.
    first = F.min(F.struct("doc_id", "sha")).alias("first")
    classes = store(usable.groupBy("key").agg(first)
                    .select("key", F.col("first.doc_id").alias("first_id"), F.col("first.sha").alias("first_sha"))
                    .orderBy("first_id", "first_sha").withColumn("id", F.monotonically_increasing_id()))
    reps = (usable.join(classes, "key").where("doc_id = first_id and sha = first_sha")
            .select("id", "n_shingles", "sig", "bands").dropDuplicates(["id"]))
    members = reps.select("id", F.explode("bands").alias("bucket"))
    # What is known of buckets is stored, so that joins may split one of very many members.
    large = store(members.groupBy("bucket").agg(F.min("id").alias("first"), F.count("*").alias("members"))
                  .where("members > 1"))
    members = store(members.join(large.drop("members"), "bucket"))
    label = None
    if not members.isEmpty():
        ids = (classes.join(members.select("id").distinct(), "id")
               .select("id", F.col("first_id").alias("doc_id"), F.col("first_sha").alias("sha")))
        sets = docs.join(ids, ["doc_id", "sha"]).dropDuplicates(["doc_id", "sha"]).select("id", "text")
        full = store(reps.join(sets.mapInArrow(_sets(size), "id long, shingles binary"), "id"))
        label = _link(members, full, per_cent)
    out = signed.join(classes, "key", "left")
    if label is not None:
        names = classes.select(F.col("id").alias("component"), F.col("first_id").alias("name"))
        out = out.join(label.withColumnRenamed("node", "id").join(names, "component"), "id", "left")
    else:
        out = out.withColumns({"component": F.col("id"), "name": F.col("first_id")})
    alone = F.col("key").isNull() | F.col("doc_id").isNull()
    named = F.when(alone, F.col("doc_id")).otherwise(F.coalesce("name", "first_id"))
    return (out.select("doc_id", "n_shingles", named.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _link(members, full, per_cent) -> DataFrame | None:
    """(node, component) of the verified links; None when there are none."""
    least = int(ROWS * (per_cent / 100 - SLACK))
    ids = members.select("id").schema

    def side(x):
        return full.select(F.col("id").alias(x), F.col("n_shingles").alias("n" + x), F.col("sig").alias("s" + x))

    # The most promising of the smallest ids that a document meets.
    alike = 100 * F.least("na", "nb") >= per_cent * F.greatest("na", "nb")
    best = (members.where("first < id").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
            .join(side("a"), "a").join(side("b"), "b").where(alike)
            .withColumn("agree", _agreement("sa", "sb")).where(F.col("agree") >= least)
            .groupBy("b").agg(F.max_by("a", "agree").alias("a")))
    kind = ids["id"].dataType.simpleString()
    pairs = (best.join(full.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
             .join(full.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    good = store(pairs.mapInArrow(_verify(per_cent), f"a {kind}, b {kind}"), 100)
    label = None if good.isEmpty() else store(components(good))

    # What several components still share is compared block by block.
    rows = members.select("bucket", "id").withColumn("component", F.col("id"))
    if label is not None:
        rows = (rows.select("bucket", "id").join(label.withColumnRenamed("node", "id"), "id", "left")
                .withColumn("component", F.coalesce("component", "id")))
    rows = rows.join(full.select("id", "n_shingles"), "id")
    weight = F.sum(F.col("n_shingles") + ROW_WEIGHT)
    left = store(rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                            F.least(F.ceil(weight / BLOCK_WEIGHT), F.count("*")).alias("blocks"))
                 .where("low <> high").select("bucket", "blocks"))
    rows = (rows.drop("n_shingles").join(left, "bucket")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("bucket", "id", "component", "block", F.least("block", "with").alias("lo"),
                    F.greatest("block", "with").alias("hi")))
    found = store(rows.join(full, "id").groupBy("bucket", "lo", "hi")
                  .applyInArrow(_compare(per_cent, least), f"a {kind}, b {kind}"))
    if found.isEmpty():
        return label
    if label is not None:
        found = found.union(label.where("node <> component").select(
            F.col("node").alias("a"), F.col("component").alias("b")))
    return store(components(found))
