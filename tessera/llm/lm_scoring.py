"""N-gram language-model scores by deleted interpolation."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.common import fold, store, words

#: Kinds of documents; a block holds one kind.  Training text counts; its
#: deleted part counts too, and the mixture weights are learned on it.
TRAIN, DELETED, HELD_OUT = 0, 1, 2
#: Width of an event's bins in quarters of a factor of two: whole factors, so
#: that the events of all estimates together stay few.
GRAIN = 4
#: Tokens of a block, and bytes of text for each count shard.
BLOCK_TOKENS, SHARD_BYTES = 1_000_000, 6_000_000
#: Text of the blocks that one scoring task takes on average.
TASK_BYTES = 16_000_000
#: Shards of one n-gram size that one counting task answers on average.
ASKED_PER_TASK = 3
#: The end of a text as a word, and the context in front of its first word.
END, START = np.uint64(0x7F4A7C159E3779B9), np.uint64(0x94D049BB133111EB)
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Block:
    """Documents of one kind as word numbers; number 0 is the end."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.ids, self.docs, self.tokens = [], [], 0

    def add(self, doc_id, text) -> None:
        seen = self.words
        found = [seen.setdefault(w, len(seen) + 1) for w in words(text)]
        found.append(0)
        self.docs.append((doc_id, len(found)))
        self.ids.append(np.array(found, dtype=np.uint32))
        self.tokens += len(found)

    def hashes(self) -> np.ndarray:
        own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        return np.concatenate([np.array([END]), own])


def _blocks(batches) -> Iterator[tuple[int, _Block]]:
    """The blocks of a partition, numbered for each kind, so that passes over
    one kind or over all of them name them alike."""
    part, made, open_ = TaskContext.get().partitionId(), Counter(), {}
    for batch in batches:
        for doc_id, text, kind in zip(*(batch.column(i).to_pylist() for i in range(3))):
            block = open_.setdefault(kind, _Block())
            block.add(doc_id, text)
            if block.tokens >= BLOCK_TOKENS:
                yield ((part << 28) + made[kind]) * 4 + kind, open_.pop(kind)
                made[kind] += 1
    for kind, block in sorted(open_.items()):
        yield ((part << 28) + made[kind]) * 4 + kind, block


def _grams(h: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each size up to ``order``, 64-bit keys of the n-grams that end in each token."""
    keys = own = h[tokens]
    starts = np.cumsum(lengths) - lengths
    yield 1, keys
    for gram in range(2, order + 1):
        before = np.empty_like(keys)
        before[1:] = keys[:-1]
        before[starts] = START
        with np.errstate(over="ignore"):
            keys = _mix(before * _U(0x9E3779B97F4A7C15) + own)
        yield gram, keys


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte: the leading bytes are mostly
    zero, and the shuffle's compression takes them out."""
    return np.diff(keys, prepend=_U(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _small(x: np.ndarray) -> bytes:
    """Counts as bytes: the first tells the width, the rest is compressed byte
    by byte, as most counts are small."""
    width = 1 if not len(x) or x.max() < 256 else 4 if x.max() < 1 << 32 else 8
    return bytes([width]) + zlib.compress(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes(), 1)


def _large(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1).T
    return np.ascontiguousarray(flat).view(f"<u{data[0]}").ravel().astype(np.int64)


def _requests(shards: int, order: int):
    """The distinct n-grams of each block with their counts, cut by key into
    shards."""
    schema = pa.schema([("shard", pa.int32()), ("gram", pa.int32()), ("block", pa.int64()),
                        ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for number, block in _blocks(batches):
            tokens = np.concatenate(block.ids)
            h = block.hashes()
            lengths = np.array([n for _, n in block.docs])
            for gram, keys in _grams(h, tokens, lengths, order):
                keys, counts = np.unique(keys, return_counts=True)
                if number % 4 == HELD_OUT:
                    counts[:] = 0
                shard = (((keys >> _U(32)) * _U(shards)) >> _U(32)).astype(np.int64)
                cut = np.searchsorted(shard, np.arange(shards + 1))
                rows = [(s, gram, number, _packed(keys[a:b]), _small(counts[a:b]))
                        for s, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Total counts for all requests of a shard and gram size, in the order of
    each request's keys; and one row of sums (block -1)."""
    keys = [_unpacked(k) for k in table["keys"].to_pylist()]
    counts = np.concatenate([_large(c) for c in table["counts"].to_pylist()])
    blocks, gram, shard = table["block"].to_numpy(), table["gram"][0].as_py(), table["shard"][0].as_py()
    sizes = [len(k) for k in keys]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, counts, len(distinct)).astype(np.int64)
    own = np.where(np.repeat(blocks, sizes) % 4 == DELETED, counts, 0)
    deleted = np.bincount(at, own, len(distinct)).astype(np.int64)
    edges = np.cumsum([0, *sizes])
    out = [(int(b), gram, shard, _small(total[at[i:j]]),
            _small(deleted[at[i:j]]) if b % 4 == DELETED else None)
           for b, i, j in zip(blocks, edges, edges[1:])]
    sums = np.array([total.sum(), (total > 0).sum(), deleted.sum()], dtype="<i8")
    out.append((-1, gram, shard, sums.tobytes(), None))
    schema = pa.schema([("block", pa.int64()), ("gram", pa.int32()), ("shard", pa.int32()),
                        ("data", pa.binary()), ("more", pa.binary())])
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _tokens(id_type: pa.DataType, kinds: tuple):
    """Each block's documents as word numbers."""
    schema = pa.schema([("block", pa.int64()), ("gram", pa.int32()), ("shard", pa.int32()),
                        ("data", pa.binary()), ("more", pa.binary()), ("docs", pa.list_(id_type))])

    def run(batches):
        for number, block in _blocks(batches):
            if number % 4 not in kinds:
                continue
            lengths = np.array([n for _, n in block.docs], dtype="<u4")
            data = np.concatenate([np.array([len(lengths)], "<u4"), lengths, *block.ids]).astype("<u4").tobytes()
            rows = [[number], [0], [0], [zlib.compress(data, 1)], [block.hashes().astype("<u8").tobytes()],
                    [[d for d, _ in block.docs]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return run


def _estimates(table: pa.Table, sums: dict, order: int, leave_out: bool):
    """A block's documents, their lengths and, per token: the counts of the
    n-grams that end in it and of their contexts, the estimates (longest first)
    and the uniform one."""
    rows = sorted(zip(*(table[c].to_pylist() for c in ("gram", "shard", "data", "more", "docs"))),
                  key=lambda r: r[:2])
    _, _, data, h, docs = rows[0]
    data = np.frombuffer(zlib.decompress(data), "<u4")
    lengths, tokens = data[1: data[0] + 1].astype(np.int64), data[data[0] + 1:].astype(np.int64)
    h = np.frombuffer(h, "<u8")
    n, v = sums["tokens"] - (sums["deleted"] if leave_out else 0), sums["distinct"]
    starts = np.cumsum(lengths) - lengths
    counts, contexts, estimates = [], [], []
    for gram, keys in _grams(h, tokens, lengths, order):
        own = [r for r in rows if r[0] == gram]
        c = np.concatenate([_large(r[2]) for r in own])
        if leave_out:
            c = c - np.concatenate([_large(r[3]) for r in own])
        distinct, at = np.unique(keys, return_inverse=True)
        if len(distinct) != len(c):
            raise ValueError("the documents changed between passes: store them first")
        counts.append(c[at])
        if gram == 1:
            context = np.full(len(tokens), n)
        else:
            context = np.empty_like(counts[-1])
            context[1:] = counts[-2][:-1]
            # Texts start as often as they end, and the last token is an end.
            context[starts] = counts[0][-1]
        contexts.append(context)
        estimates.insert(0, np.where(context > 0, counts[-1] / np.maximum(context, 1), 0.0))
    return docs, lengths, counts, contexts, estimates, 1.0 / (v + 1)


def _seen(contexts: list) -> np.ndarray:
    """Size of the longest n-gram whose context was seen; 1 without any."""
    return 1 + sum((c > 0).astype(np.int64) for c in contexts[1:])


def _bucket(contexts: list) -> np.ndarray:
    """The longest seen context's size and log2 of its count, rounded down; 0
    for none."""
    bucket = np.zeros(len(contexts[0]), dtype=np.int64)
    for i, c in enumerate(contexts[1:]):
        bucket = np.where(c > 0, 64 * i + 1 + np.floor(np.log2(np.maximum(c, 1))).astype(np.int64), bucket)
    return bucket


def _event_columns(order: int) -> list[str]:
    return ["bucket", *(f"x{gram}" for gram in range(order, 0, -1)), "n"]


def _events(sums: dict, order: int):
    def run(table: pa.Table) -> pa.Table:
        _, _, _, contexts, estimates, last = _estimates(table, sums, order, True)
        with np.errstate(divide="ignore"):
            bins = [np.where(p > 0, GRAIN * np.round(4 / GRAIN * np.log2(p / last)), -999).astype(np.int64) for p in estimates]
        rows, n = np.unique(np.stack([_bucket(contexts), *bins], axis=1), axis=0, return_counts=True)
        return pa.table(dict(zip(_event_columns(order), [*rows.T, n.astype(np.int64)])))

    return run


def learn_weights(events: list[tuple], rounds: int = 60, order: int = 2) -> dict[int, np.ndarray]:
    """Mixture weights (longest n-gram to word, then uniform) per context
    bucket, by expectation-maximisation over (bucket, one x per estimate, n):
    how often the estimates were about 2^(x/4) times the uniform one (-999: zero).
    Key -1 has the weights over all buckets."""
    data = np.array(events, dtype=np.int64).reshape(-1, order + 2)
    out = {}
    for b in [-1, *np.unique(data[:, 0]).tolist()]:
        own = data if b < 0 else data[data[:, 0] == b]
        p = np.ones((len(own), order + 1))
        for k in range(order):
            p[:, k] = np.where(own[:, k + 1] == -999, 0.0, 2.0 ** (own[:, k + 1] / 4))
        weight, n = np.full(order + 1, 1 / (order + 1)), own[:, -1].astype(float)
        for _ in range(rounds if len(own) else 0):
            share = p * weight
            share *= (n / share.sum(axis=1))[:, None]
            weight = share.sum(axis=0) / n.sum()
        # Every word keeps some probability.
        weight = weight * (1 - 1e-6)
        weight[-1] += 1e-6
        out[b] = weight
    return out


def _score(sums: dict, weights: dict, order: int):
    lookup = np.array([weights.get(b, weights[-1]) for b in range(64 * order + 1)])

    def run(table: pa.Table) -> pa.Table:
        docs, lengths, counts, contexts, estimates, last = _estimates(table, sums, order, False)
        w, seen = lookup[_bucket(contexts)].copy(), _seen(contexts)
        # An unseen context has no estimate; the others share its weight.
        for size in range(1, order):
            at, gone = seen == size, order - size
            w[at, gone:] += w[at, :gone].sum(axis=1, keepdims=True) / (size + 1)
            w[at, :gone] = 0
        if not sums["tokens"]:
            w[:] = 0
            w[:, -1] = 1
        model = np.log10(sum(w[:, k] * p for k, p in enumerate([*estimates, last])))
        base = np.log10((counts[0] + 0.1) / (sums["tokens"] + 0.1 * (sums["distinct"] + 1)))
        starts = np.cumsum(lengths) - lengths
        held_out = table["block"][0].as_py() % 4 == HELD_OUT
        return pa.table({
            "doc_id": pa.array(docs, table.schema.field("docs").type.value_type), "held_out": pa.array([held_out] * len(docs), pa.bool_()), "n_tokens": lengths,
            "n_known": np.add.reduceat((counts[0] > 0).astype(np.int64), starts),
            "train_tokens": np.full(len(docs), sums["tokens"], dtype=np.int64),
            "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(model, starts)})

    return run


def lm_score(docs: DataFrame, *, order: int = 3, folds: int = 10, held_out: int = 0, deleted: int = 1) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score``.

    Documents of fold ``held_out`` (crc32 of the id) are scored only; all
    others are counted.  A token's probability mixes the maximum-likelihood
    estimates of the n-grams of up to ``order`` words that end in it with a
    uniform one, 1 / (distinct words + 1); the weights belong to the longest
    seen context's size and frequency (powers of two) and are learned by
    expectation-maximisation on fold ``deleted``, with that fold's own counts
    taken out.

    Counts are exact over all training text.  A block of documents asks once
    for each of its distinct n-grams, so a frequent one costs a row
    per block; shards of keys answer, and the number of shards grows with the
    text.  Keys are 64-bit fingerprints.  Only sums over shards and the binned
    events (bounded by buckets and bins) reach the driver.

    Texts of any length are read whole, one at a time into a block that ends
    with them.  A null or empty text has one token, its end; a null id counts as empty
    text for its fold; repeated rows count and score each; an empty table
    gives an empty result; other columns are ignored.  ``docs`` is read three
    times and has to come in the same order each time, as a stored table does;
    if it does not, the operator raises.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    of = fold(F.col("doc_id"), folds)
    base = docs.select("doc_id", "text", F.when(of == held_out, HELD_OUT)
                       .when(of == deleted, DELETED).otherwise(TRAIN).cast("int").alias("kind"))
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(4, -(-text_bytes // SHARD_BYTES))
    asked = base.mapInArrow(_requests(shards, order), "shard int, gram int, block long, keys binary, counts binary")
    # As many tasks as the text asks for, not as the session has shuffle partitions.
    asked = asked.repartition(max(4, shards * order // ASKED_PER_TASK), "shard", "gram")
    answers = store(asked.groupBy("shard", "gram").applyInArrow(
        _answer, "block long, gram int, shard int, data binary, more binary"), 32)
    found = [np.frombuffer(r.data, "<i8") for r in answers.where("block = -1 and gram = 1").collect()]
    tokens, distinct, out = (int(x) for x in sum(found)) if found else (0, 0, 0)
    sums = {"tokens": tokens, "distinct": distinct, "deleted": out}
    replies = answers.where("block >= 0").withColumn("docs", F.lit(None).cast(f"array<{kind}>"))
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    shape = f"block long, gram int, shard int, data binary, more binary, docs array<{kind}>"

    tasks = max(4, -(-text_bytes // TASK_BYTES))

    def blocks(rows: DataFrame, kinds: tuple, answers: DataFrame):
        tokens_of = rows.mapInArrow(_tokens(id_type, kinds), shape)
        return tokens_of.union(answers).repartition(tasks, "block").groupBy("block")

    events = blocks(base.where(F.col("kind") == DELETED), (DELETED,),
                    replies.where(F.col("block") % 4 == DELETED)).applyInArrow(
        _events(sums, order), ", ".join(f"{c} long" for c in _event_columns(order)))
    events = events.groupBy(*_event_columns(order)[:-1]).agg(F.sum("n").alias("n")).collect()
    weights = learn_weights([tuple(r) for r in events], order=order)
    return store(blocks(base, (TRAIN, DELETED, HELD_OUT), replies).applyInArrow(
        _score(sums, weights, order), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double"))
