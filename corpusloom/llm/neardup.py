"""Near-duplicate texts by deletion-variant signatures."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.cluster import broadcast_if_small, checkpoint

WORD = re.compile("[0-9A-Za-z가-힣]+")
#: Bits of the sketch that travel with every signature; the other bits of that number tell texts apart.
SHORT = 48


class Signer:
    """Fingerprints of texts: one minimum a hash function over a text's distinct word sequences.

    A fingerprint is cut into ``segments`` of ``width`` minima. Each segment gives ``width`` signatures,
    one for each minimum that is left out, so two texts share a signature if any segment of theirs
    differs in at most one place. Two texts of similarity J have a segment in common with probability
    J^w + w (1 - J) J^(w-1).
    """

    def __init__(self, shingle: int, segments: int, width: int, seed: int = 20240229):
        self.shingle, self.segments, self.width = shingle, segments, width
        random = np.random.default_rng(seed)
        many = segments * width
        self.factors = random.integers(1, 2**63, many, dtype=np.uint64) | np.uint64(1)
        self.places = random.integers(1, 2**63, many, dtype=np.uint64) | np.uint64(1)
        self.words: dict[str, int] = {}

    def shingles(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct shingle hashes of all texts, one text after another, and where each text ends."""
        words, ends = [], []
        for text in texts:
            words += WORD.findall(text.lower()) if text else ()
            ends.append(len(words))
        if len(self.words) > 2_000_000:
            self.words.clear()
        codes = np.empty(len(words), dtype=np.uint64)
        known = self.words
        for i, word in enumerate(words):
            if (code := known.get(word)) is None:
                code = known[word] = _hash64(word)
            codes[i] = code
        ends = np.array(ends, dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        k, n = self.shingle, len(codes)
        if n < k:
            return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
        mixed = np.zeros(n - k + 1, dtype=np.uint64)
        for i in range(k):
            mixed = (mixed ^ codes[i : n - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        row = np.repeat(np.arange(len(texts)), ends - starts)[: n - k + 1]
        whole = np.arange(n - k + 1) + k <= ends[row]
        mixed, row = mixed[whole], row[whole]
        order = np.lexsort((mixed, row))
        mixed, row = mixed[order], row[order]
        first = np.ones(len(mixed), dtype=bool)
        first[1:] = (mixed[1:] != mixed[:-1]) | (row[1:] != row[:-1])
        mixed, row = mixed[first], row[first]
        return mixed, np.cumsum(np.bincount(row, minlength=len(texts)))

    def fingerprints(self, shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A row of minima for each text that has shingles. ``ends`` without those that have none."""
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        out = np.empty((len(starts), len(self.factors)), dtype=np.uint32)
        base = shingles ^ (shingles >> np.uint64(32))
        for i, factor in enumerate(self.factors):
            out[:, i] = np.minimum.reduceat(((base * factor) >> np.uint64(32)).astype(np.uint32), starts)
        return out

    def signatures(self, prints: np.ndarray) -> np.ndarray:
        """(texts, segments x width) signatures: each segment's sum without one of its places."""
        spread = (prints.astype(np.uint64) * self.places) ^ (prints.astype(np.uint64) << np.uint64(21))
        spread = (spread ^ (spread >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        parts = spread.reshape(len(prints), self.segments, self.width)
        left = parts.sum(axis=2, keepdims=True, dtype=np.uint64) - parts
        mark = np.arange(self.segments * self.width, dtype=np.uint64).reshape(1, self.segments, self.width)
        left = (left ^ (mark * np.uint64(0x94D049BB133111EB))) * np.uint64(0x9E3779B97F4A7C15)
        return (left ^ (left >> np.uint64(32))).reshape(len(prints), -1)


def shape(threshold: float, miss: float = 2e-4, most: int = 128) -> tuple[int, int]:
    """(segments, width): the longest segments, and so the rarest signatures, with which two texts exactly
    at the threshold are missed no more often than ``miss`` and a text has at most ``most`` signatures."""
    for width in range(12, 1, -1):
        one = threshold**width + width * (1 - threshold) * threshold ** (width - 1)
        segments = math.ceil(math.log(miss) / math.log(1 - one)) if one < 1 else 1
        if segments * width <= most:
            return segments, width
    raise ValueError(f"no signature of at most {most} variants finds texts of similarity {threshold}")


def _hash64(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def packed(prints: np.ndarray, bits: int) -> np.ndarray:
    """The lowest ``bits`` bits of every minimum, as many to a signed long as fit into 60 bits."""
    each = 60 // bits
    words = -(-prints.shape[1] // each)
    parts = np.zeros((len(prints), words * each), dtype=np.int64)
    parts[:, : prints.shape[1]] = prints & ((1 << bits) - 1)
    return (parts.reshape(len(prints), words, each) << (bits * np.arange(each, dtype=np.int64))).sum(axis=2)


def equal_nibbles(a: Column, b: Column) -> Column:
    """How many of the 15 groups of four bits of two longs agree."""
    differ = a.bitwiseXOR(b)
    pairs = differ.bitwiseOR(F.shiftrightunsigned(differ, 1))
    groups = pairs.bitwiseOR(F.shiftrightunsigned(pairs, 2))
    return 15 - F.bit_count(groups.bitwiseAND(F.lit(0x111111111111111)))


def _lists(flat: pa.Array, each: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, each, dtype=np.int32)), flat)


def _shingled(batches: Iterator[pa.RecordBatch], signer: Signer, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows whose second column, a text, has shingles: the rows, all shingles, their numbers and ends."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            shingles, ends = signer.shingles(part.column(1).to_pylist())
            sizes = np.diff(ends, prepend=0)
            have = np.flatnonzero(sizes)
            if len(have):
                yield part.take(pa.array(have)), shingles, sizes[have], ends[have]


def classes(docs: DataFrame, key: str, text: str, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Every distinct key with its text's digest, whether that has a shingle and how many rows it has, and the
    digests' representatives.

    Equal texts are one class, named by its least key. Only digests move.
    """
    body = F.col(text)
    word, gap = "[0-9A-Za-z가-힣]+", "[^0-9A-Za-z가-힣]+"
    rows = (
        docs.where(F.col(key).isNotNull() & body.isNotNull())
        .select(F.col(key).alias("member"), F.xxhash64(body).alias("a"), F.xxhash64(F.lit(7), body, F.length(body)).alias("b"), body.rlike(f"{word}(?:{gap}{word}){{{shingle - 1}}}").alias("comparable"))
        .groupBy("member", "a", "b", "comparable")
        .agg(F.count("*").alias("times"))
    )
    return rows, rows.groupBy("a", "b").agg(F.min("member").alias("rep"), F.count("*").alias("copies"))


def near_duplicates(docs: DataFrame, key: str = "id", text: str = "body", shingle: int = 5, threshold: float = 0.8, miss: float = 2e-4, slack: float = 4.5, max_broadcast: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """Links (``a``, ``b``, ``similarity``) of different texts, and members (``member``, ``rep``, ``comparable``).

    Similarity is the number of distinct word sequences of length ``shingle`` that two texts share over
    the number in either; words are runs of digits, Latin letters and Hangul syllables in lower case.
    Links join representatives, a < b; copies need not be expanded and share their representative's
    links. Texts without such a sequence (empty, too short) have no links. Null keys or texts are left
    out. Repeated rows are one; a key with several texts takes part with each. Other columns are not
    read. No rows: no links.

    Signatures (see ``Signer``) are equality-joined; a pair exactly at the threshold is missed with the
    probability ``miss``, more similar ones far less often; texts whose 64-bit stand-ins coincide are
    candidates without a shared signature, told apart by their full numbers. A candidate goes on if the
    sketches of the whole fingerprints, four bits a minimum, agree as often as the threshold lets expect,
    less ``slack`` standard deviations; then the exact sets decide. Copies' and candidates' keys are broadcast if there are at
    most ``max_broadcast``, else joined. A signature that very many texts share is a skewed key of a
    plain sort-merge join, which adaptive execution splits; no bucket is gathered anywhere.
    """
    segments, width = shape(threshold, miss)
    rows, groups = classes(docs, key, text, shingle)
    # Texts are hashed once; what follows reads the digests.
    digests = checkpoint(rows.join(groups, ["a", "b"]).select("member", "a", "b", "rep", "comparable", "times"))
    members = digests.select("member", "rep", "comparable")
    # Copies are removed by a join that leaves the texts where they are, unless very many are copies; of
    # representatives only those with several rows move, to become one.
    spare = digests.where("member <> rep or times > 1").select(F.col("member").alias("k"), "a", "b", F.expr("member = rep").alias("repeated"))
    spare, _ = broadcast_if_small(spare, max_broadcast)
    known = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    keyed = known.withColumn("a", F.xxhash64("t")).withColumn("b", F.xxhash64(F.lit(7), F.col("t"), F.length("t")))
    repeated = keyed.join(spare.where("repeated"), ["k", "a", "b"], "left_semi").dropDuplicates(["k", "a", "b"])
    reps = keyed.join(spare, ["k", "a", "b"], "left_anti").unionByName(repeated).select("k", "a", "t")

    reps = reps.withColumn("u", F.xxhash64("k", "a"))  # joined by a number, rows stay small

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(shingle, segments, width)
        for part, shingles, sizes, ends in _shingled(batches, signer):
            prints = signer.fingerprints(shingles, ends)
            sketch = packed(prints, 4)
            flat = pa.array(prints.view(np.int32).reshape(-1))
            # What stands for the text in the join: the sketch's first bits, and some of its name's digest.
            short = ((packed(prints[:, :SHORT], 1)[:, 0] & ((1 << SHORT) - 1)) << (64 - SHORT)) | (part.column(0).to_numpy() & ((1 << (64 - SHORT)) - 1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(short), pa.array(sizes.astype(np.int32)), _lists(pa.array(sketch.reshape(-1)), sketch.shape[1]), _lists(flat, prints.shape[1])], names=["u", "e", "n", "sketch", "prints"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(shingle, segments, width)
        for batch in batches:
            if batch.num_rows:
                prints = batch.column(1).flatten().to_numpy().view(np.uint32).reshape(batch.num_rows, -1)
                signatures = signer.signatures(prints).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), signatures.shape[1])), pa.array(signatures.reshape(-1))], names=["e", "s"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(shingle, segments, width)
        for part, shingles, _, ends in _shingled(batches, signer):
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.ListArray.from_arrays(offsets, pa.array(shingles.view(np.int64)))], names=["u", "k", "shingles"])

    # Written once, read by the signatures and by both sides of the comparison of sketches.
    signed = checkpoint(reps.select("u", "t").mapInArrow(sign, "u long, e long, n int, sketch array<long>, prints array<int>"))
    entries = signed.select("e", "prints").mapInArrow(cut, "e long, s long")
    many, differing, agreeing = segments * width, (1 - threshold) / 2, threshold + (1 - threshold) / 16
    spread = lambda n, p: (n * p * (1 - p)) ** 0.5
    # Both sides are one plan, so their exchange is made once. Most chance pairs end here, unmoved.
    like = F.bit_count(F.shiftrightunsigned(F.col("x.e").bitwiseXOR(F.col("y.e")), 64 - SHORT)) <= int(SHORT * differing + (slack - 0.5) * spread(SHORT, differing)) + 1
    candidates = entries.alias("x").join(entries.alias("y").hint("merge"), F.col("x.s") == F.col("y.s")).where((F.col("x.e") < F.col("y.e")) & like).select(F.col("x.e").alias("ea"), F.col("y.e").alias("eb")).distinct()
    # Texts with one stand-in cannot meet as two numbers above; they are candidates as they are.
    alike = signed.groupBy("e").agg(F.count("*").alias("texts")).where("texts > 1").select(F.col("e").alias("ea"), F.col("e").alias("eb"))
    words = -(-many // 15)
    same = sum((equal_nibbles(F.col("xa")[i], F.col("xb")[i]) for i in range(words)), F.lit(many - 15 * words))
    size = lambda side: signed.select(F.col("e").alias(f"e{side}"), F.col("u").alias(f"u{side}"), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"x{side}"))
    close = checkpoint(
        candidates.unionByName(alike)
        .join(size("a"), "ea")
        .join(size("b"), "eb")
        .where(((F.col("ea") < F.col("eb")) | (F.col("ua") < F.col("ub"))) & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold - 1e-9) & (same >= int(many * agreeing - slack * spread(many, agreeing))))
        .select("ua", "ub")
        .distinct()
    )
    # The exact sets are made again, of the candidates' texts alone.
    wanted, _ = broadcast_if_small(close.select(F.col("ua").alias("u")).union(close.select(F.col("ub").alias("u"))).distinct(), max_broadcast)
    sets = reps.join(wanted, "u", "left_semi").select("u", "t", "k").mapInArrow(exact, "u long, k string, shingles array<long>")
    shared = F.size(F.array_intersect("x.shingles", "y.shingles"))
    verified = (
        close.join(sets.alias("x"), F.col("ua") == F.col("x.u"))
        .join(sets.alias("y"), F.col("ub") == F.col("y.u"))
        .select(F.col("x.k").alias("ka"), F.col("y.k").alias("kb"), shared.alias("shared"), (F.size("x.shingles") + F.size("y.shingles")).alias("both"))
        .withColumn("similarity", F.col("shared") / (F.col("both") - F.col("shared")))
        .where((F.col("similarity") >= threshold) & (F.col("ka") != F.col("kb")))
        .select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"), "similarity")
    )
    return verified, members


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(``node``, ``class_id``) of every node of the links: the least node that it is connected to.

    Every round gives each node the least label around it and then that label's own label, so a chain of
    length n needs about log n rounds. Labels are written after every round. A hub's neighbours meet in
    a partial minimum before they are moved.
    """
    both = checkpoint(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label"))
    labels = checkpoint(labels)
    for _ in range(rounds):
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        nearer = labels.join(around, "node").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        jumped = nearer.alias("x").join(labels.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left").select("node", F.least("label", F.coalesce("root", "label")).alias("label"), "old")
        new = checkpoint(jumped)
        moved = not new.where("label <> old").isEmpty()
        labels = new.select("node", "label")
        if not moved:
            return labels.select("node", F.col("label").alias("class_id"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicate_classes(docs: DataFrame, key: str = "id", **options) -> DataFrame:
    """One row a distinct key: key, ``class_id`` (the least key of its group), ``links`` to different texts.

    Keys whose texts resemble no other are classes of their own. See ``near_duplicates`` for the rest.
    """
    links, members = near_duplicates(docs, key, **options)
    links, members = checkpoint(links.select("a", "b").distinct()), members.select("member", "rep").distinct()
    ends = links.select(F.col("a").alias("rep")).union(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("links"))
    labels = components(links).select(F.col("node").alias("rep"), "class_id").join(ends, "rep")
    return (
        members.join(labels, "rep", "left")
        .groupBy(F.col("member").alias(key))
        .agg(F.min(F.coalesce("class_id", "rep")).alias("class_id"), F.sum(F.coalesce("links", F.lit(0))).alias("links"))
    )


def expand_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs (``id_a`` < ``id_b``) of different members of linked or equal texts."""
    across = links.join(members.select(F.col("rep").alias("a"), F.col("member").alias("x")), "a").join(members.select(F.col("rep").alias("b"), F.col("member").alias("y")), "b").select("x", "y")
    several = members.where("comparable and member <> rep").select("rep").distinct()
    copied = members.join(several, "rep")
    within = copied.select("rep", F.col("member").alias("x")).join(copied.select("rep", F.col("member").alias("y")), "rep").where("x < y").select("x", "y")
    return across.union(within).where("x <> y").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
