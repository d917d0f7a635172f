"""Phrase collocations by the stripes pattern."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import store

#: Fixed values of the contract: what ends a piece of text, and the scale of a score.
PIECE_ENDS, SCALE = ".,;:!?\x0a\x0b\x0c\x0d", 1_000_000
#: Bytes that no UTF-8 text holds: the end of a piece, of a language, of a word.
END, OF_LANG, NEXT = b"\xff", b"\xfe", b"\xfd"
#: A-Z lower-cased, piece ends turned into END.
TABLE = bytes(END[0] if chr(b) in PIECE_ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Tokens and distinct words gathered before stripes leave a task, and bytes of text split at once.
TOKENS, WORDS, CUT = 1_000_000, 1 << 19, 1 << 20
#: Parts that a language's phrases are limited in before they are ranked.
SALTS = 64
#: Odd numbers that mix two word hashes into a stripe's.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)

STRIPES = ("bucket int, words binary, first binary, second binary, sizes binary, after binary, times binary, "
           "single binary, single_times binary")
COUNTED = "lang string, w1 string, w2 string, w3 string, times long, prefix long, longest long"


class _Numbers(dict):
    """Number of each word of a language, dealt at first sight; 0 is END."""
    def __init__(self, lang: bytes, names: list[bytes]):
        super().__init__({END: 0})
        self.lang, self.names = lang + OF_LANG, names

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(self.lang + word)
        return n


def _stripes(ids: np.ndarray, names: list[bytes], buckets: int):
    """Stripes of a run of tokens, one row for each bucket: of the empty prefix
    (each word) and of every prefix of two words (its next words, END too)."""
    a, b, c = ids[:-2].astype(np.int64), ids[1:-1], ids[2:]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), dtype=np.uint64, count=len(names))
    times = np.bincount(a, minlength=len(names))
    times[0] = 0
    single = np.flatnonzero(times)
    single_at = (hashes[single] % np.uint64(buckets)).astype(np.int64)
    inside = (a > 0) & (b > 0)
    key, count = np.unique((a[inside] << 42) | (b[inside].astype(np.int64) << 21) | c[inside], return_counts=True)
    first, second, after = key >> 42, (key >> 21) & 0x1FFFFF, key & 0x1FFFFF
    mixed = hashes[first] * MIX[0] + hashes[second] * MIX[1]
    at = ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)
    order, single_order = np.argsort(at, kind="stable"), np.argsort(single_at, kind="stable")
    edge = np.searchsorted(at[order], np.arange(buckets + 1))
    single_edge = np.searchsorted(single_at[single_order], np.arange(buckets + 1))
    for k in range(buckets):
        rows, ones = order[edge[k]: edge[k + 1]], single[single_order[single_edge[k]: single_edge[k + 1]]]
        if not len(rows) and not len(ones):
            continue
        x, y, z = first[rows], second[rows], after[rows]
        new = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])][:len(x)])
        used = np.unique(np.concatenate([[0], x[new], y[new], z, ones]))
        place = [np.searchsorted(used, v).astype(np.uint32).tobytes() for v in (x[new], y[new], z, ones)]
        yield (k, NEXT.join([names[u] for u in used]), place[0], place[1],
               np.diff(np.r_[new, len(x)]).astype(np.uint32).tobytes(), place[2],
               count[rows].astype(np.uint32).tobytes(), place[3], times[ones].astype(np.uint32).tobytes())


def _count(buckets: int):
    """Texts (lang, text as bytes) to stripes, combined over TOKENS tokens."""
    def run(batches):
        names: list[bytes] = [b""]
        numbers: dict[bytes, _Numbers] = {}
        parts: list[np.ndarray] = []
        held = 0

        def number(lang: bytes) -> _Numbers:
            if lang not in numbers:
                numbers[lang] = _Numbers(lang, names)
            return numbers[lang]

        def put(ids: list[int]):
            nonlocal held
            parts.append(np.array(ids, dtype=np.int32))
            held += len(ids)

        def flush(inside: bool):
            """Rows of the tokens held.  Inside a text the last two stay, as
            their next words are still to come."""
            nonlocal names, numbers, parts, held
            ids = np.concatenate([*parts, np.zeros(0 if inside else 2, dtype=np.int32)])
            rows = list(zip(*_stripes(ids, names, buckets)))
            stay = [names[i].split(OF_LANG) for i in ids[-2:]] if inside else []
            names, numbers, parts, held = [b""], {}, [], 0
            put([number(word[0])[word[1]] if word[1:] else 0 for word in stay])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int32()), *[pa.array(r, pa.binary()) for r in rows[1:]]],
                    names=[f.split()[0] for f in STRIPES.split(", ")])

        for batch in batches:
            for lang, text in zip(*(column.to_pylist() for column in batch.columns)):
                at = 0
                while at < len(text):
                    # A cut falls on a blank or line break, so words stay whole.
                    end = at + CUT
                    while end < len(text) and text[end] not in b" \t\n":
                        end += 1
                    tokens = text[at: end].translate(TABLE).replace(END, b" " + END + b" ").split()
                    at = end
                    put(list(map(number(lang).__getitem__, tokens)))
                    if held >= TOKENS or len(names) >= WORDS:
                        yield from flush(at < len(text) and held > 2)
                put([0])
        yield from flush(False)
    return run


def _merge(least: int):
    """All stripes of a bucket, added up elementwise: what occurs ``least``
    times, with the total of its prefix (w3 known) or its largest extension of
    that many (w3 null); and every word, rare ones summed up by language."""
    def run(table: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {b"": 0}
        parts: list[list[np.ndarray]] = [[] for _ in range(6)]
        for row in zip(*(table[c].to_pylist() for c in table.column_names[1:])):
            words = row[0].split(NEXT)
            ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
            x, y, size, z, n, one, m = (np.frombuffer(v, dtype=np.uint32) for v in row[1:])
            for part, v in zip(parts, (np.repeat(ids[x], size), np.repeat(ids[y], size), ids[z], n, ids[one], m)):
                part.append(v)
        x, y, z, n, one, m = (np.concatenate(p) for p in parts)
        names = list(numbers)
        prefix, of = np.unique((x << 32) | y, return_inverse=True)
        entry, same = np.unique((of << 32) | z, return_inverse=True)
        times, total = np.zeros(len(entry), dtype=np.int64), np.zeros(len(prefix), dtype=np.int64)
        np.add.at(times, same, n)
        of, z = entry >> 32, entry & 0xFFFFFFFF
        np.add.at(total, of, times)
        word = np.zeros(len(names), dtype=np.int64)
        np.add.at(word, one, m)
        large = (times >= least) & (z > 0)
        longest = np.zeros(len(prefix), dtype=np.int64)
        np.maximum.at(longest, of[large], times[large])

        def name(i):
            return names[i].split(OF_LANG, 1)[1].decode()

        def lang(i):
            return names[i].split(OF_LANG, 1)[0].decode()

        out, rare = [], {}
        for i in np.flatnonzero(word):
            if word[i] >= least:
                out.append((lang(i), name(i), None, None, word[i], None, None))
            else:
                rare[lang(i)] = rare.get(lang(i), 0) + word[i]
        out += [(code, None, None, None, n, None, None) for code, n in rare.items()]
        for p in np.flatnonzero(total >= least):
            i, j = prefix[p] >> 32, prefix[p] & 0xFFFFFFFF
            out.append((lang(i), name(i), name(j), None, total[p], None, longest[p]))
        for e in np.flatnonzero(large):
            i, j = prefix[of[e]] >> 32, prefix[of[e]] & 0xFFFFFFFF
            out.append((lang(i), name(i), name(j), name(z[e]), times[e], total[of[e]], None))
        fields = [f.split() for f in COUNTED.split(", ")]
        cols = list(zip(*out)) or [()] * len(fields)
        return pa.table({f: pa.array(c, pa.string() if t == "string" else pa.int64()) for (f, t), c in zip(fields, cols)})
    return run


def stripe_counts(docs: DataFrame, *, least: int, bucket_bytes: int = 1 << 23) -> DataFrame:
    """Merged stripes of all texts (COUNTED).  Prefixes are dealt to buckets by
    their hash, so that the stripes of a frequent word's prefixes spread, and a
    bucket holds the tokens of ``bucket_bytes`` of text on average."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).cast("binary").alias("lang"),
                        F.col("text").cast("binary").alias("text")).where(F.length("text") > 0)
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / bucket_bytes))
    stripes = texts.mapInArrow(_count(buckets), STRIPES).repartition(buckets, "bucket")  # tasks grow with the text
    return store(stripes.groupBy("bucket").applyInArrow(_merge(least), COUNTED))


def _score(left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exact for counts under 10^15."""
    wide = {c: f"cast({c} as decimal(15,0))" for c in ("a", left, right)}
    return F.expr(f"cast(cast({SCALE} as decimal(7,0)) * ({wide['a']} * {wide['a']}) as decimal(38,0)) "
                  f"div ({wide[left]} * {wide[right]})").cast("long")


def _best(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language, with their ``rank``.  A histogram
    of scores, of a few hundred rows a language, tells which of its bins can be
    among them; SALTS parts of a language are limited first, so one task never
    orders more than SALTS * ``top`` rows, however many tie."""
    scored = store(scored.withColumn("bin", F.floor(16 * F.log1p("score"))))
    bins = scored.groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("rows"))
    above = F.coalesce(F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("bin")).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    reached = bins.withColumn("above", above).where(F.col("above") < top).select("lang", "bin")
    order = F.desc("score"), F.desc("a"), "phrase"
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = (scored.join(reached, ["lang", "bin"]).withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= top))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))


def collocations(docs: DataFrame, *, least: int = 10, share: int = 50, top: int = 2000,
                 bucket_bytes: int = 1 << 23) -> DataFrame:
    """Best ``top`` phrases of two or three words of each language: ``lang, rank,
    phrase, a, l, r, n, score``.

    ``docs`` has ``lang, text``.  Texts are lower-cased (A-Z), split at
    PIECE_ENDS into pieces and those at blanks and tabs into words; a phrase is
    a run of words within a piece that occurs ``least`` times.  One structure
    gives all counts (``stripe_counts``): a prefix of two words keys a counter
    of its next words, the empty prefix one of all words, and stripes of one
    prefix are added up elementwise.  The total of a stripe is f(prefix), its
    entries are the extensions, its largest frequent entry shows whether one
    subsumes the prefix; an extension to the left is the largest entry of the
    word in another prefix's stripe.  Phrases inside a longer one with at least
    ``share`` percent of their count are dropped, the others scored by their
    weakest cut, in whole numbers.

    A null text counts as empty, a null language as ``und``; repeated rows
    count each; a very long text is split ``CUT`` bytes at a time and whole
    ones cross the cuts.  Languages rank by themselves; ties go to the larger
    count, then the smaller phrase.  An empty table gives an empty result;
    other columns are ignored.
    """
    found = stripe_counts(docs, least=least, bucket_bytes=bucket_bytes)
    words = found.where("w1 is not null and w2 is null").select("lang", "w1", F.col("times").alias("f"))
    totals = found.where("w2 is null").groupBy("lang").agg(F.sum("times").alias("n"))
    pairs = found.where("w2 is not null and w3 is null").select("lang", "w1", "w2", F.col("times").alias("a"), "longest")
    triples = found.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("times").alias("a"),
                                                   F.col("prefix").alias("head"))
    to_left = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("left"))
    two = (pairs.join(to_left, ["lang", "w1", "w2"], "left")
           .where(100 * F.greatest("longest", F.coalesce("left", F.lit(0))) < share * F.col("a"))
           .select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "a",
                   F.lit(None).cast("long").alias("head"), F.lit(None).cast("long").alias("tail")))
    tails = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("tail"))
    three = triples.join(tails, ["lang", "w2", "w3"]).select(two.columns)
    last = words.select("lang", F.col("w1").alias("last"), F.col("f").alias("f_last"))
    both = (two.unionByName(three).withColumn("last", F.coalesce("w3", "w2"))
            .join(words.withColumnRenamed("f", "f_first"), ["lang", "w1"]).join(last, ["lang", "last"])
            .withColumns({"r1": F.coalesce("tail", "f_last"), "l2": F.coalesce("head", "f_first")})
            .withColumns({"s1": _score("f_first", "r1"), "s2": _score("l2", "f_last")})
            .withColumn("second", F.col("s2") < F.col("s1"))
            .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                    F.when(F.col("second"), F.col("l2")).otherwise(F.col("f_first")).alias("l"),
                    F.when(F.col("second"), F.col("f_last")).otherwise(F.col("r1")).alias("r"),
                    F.least("s1", "s2").alias("score")))
    best = _best(both, top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                            "a", "l", "r", "n", "score")
