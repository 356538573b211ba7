"""Texts that end before their own end."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.cluster import checkpoint
from corpusloom.llm.filters import Filter, hash_filter

#: Context lengths of the backward model, in characters before the end; the first level ignores the line.
ORDERS = (2, 4, 6)
PLAIN = 3
LEVELS = 1 + len(ORDERS)
#: Marks that a cut leaves behind; the context before them is what counts.
_MARK = re.compile(r"(?:…|�|\.{2,}|\[(?:cut|truncated|more|중략|생략|계속|이하 생략)\]|\((?:cut|truncated|more|continued|이하 생략|하략|생략|계속)\))$")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def without_mark(text: str) -> str:
    """The text without trailing white space and marks of a cut. Only the end is looked at."""
    bare = text.rstrip()
    while bare and (bare[-1] in "…�.])" and (mark := _MARK.search(bare, max(0, len(bare) - 16)))):
        bare = bare[: mark.start()].rstrip()
    return bare


class Contexts:
    """Keys of the contexts of a chunk of texts: the characters before a place, with digits as one, the kind
    of line (the classes of its first two characters and whether a colon came), how many words of the line
    came before, and the text's script."""

    def __init__(self, texts: list[str]):
        joined = "".join(f"\n{t}\0" for t in texts)
        self.codes = codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = len(codes)
        index = np.arange(n)
        stop = (codes == 10) | (codes == 0)
        self.start = start = np.minimum(np.maximum.accumulate(np.where(stop, index + 1, 0)), n - 1)
        spaces = np.cumsum(codes == 32)
        self.words = np.minimum(spaces - spaces[start], 5).astype(np.uint64)
        hangul = (codes >= 0xAC00) & (codes <= 0xD7A3)
        digit = (codes >= 48) & (codes <= 57)
        classes = codes.astype(np.uint64)
        classes[digit] = 48
        kinds = np.where(hangul, 1, np.where(digit, 4, np.where((codes >= 65) & (codes <= 90), 2, np.where((codes >= 97) & (codes <= 122), 3, codes)))).astype(np.uint64)
        second = kinds[np.minimum(start + 1, n - 1)]
        colons = np.cumsum(codes == 58)
        labelled = (colons > colons[start]).astype(np.uint64)
        self.kind = (kinds[start] * np.uint64(0x10000) + second) * np.uint64(2) + labelled
        ends = np.flatnonzero(codes == 0)
        lengths = np.diff(ends, prepend=-1)
        share = np.add.reduceat(hangul.astype(np.int64), np.concatenate([[0], ends[:-1] + 1])) if len(ends) else np.zeros(0)
        self.script = np.repeat((share * 5 > lengths).astype(np.uint64), lengths)
        self.classes, self.ends, self.hangul = classes, ends, hangul

    def keys(self, places: np.ndarray) -> list[np.ndarray]:
        """The key of each order at each place (the index of a context's last character)."""
        mixed = (self.script[places] + np.uint64(3)) * _MULTIPLIER
        for back in range(PLAIN):
            mixed = (mixed ^ self.classes[np.maximum(places - back, 0)]) * _MULTIPLIER
            mixed ^= mixed >> np.uint64(29)
        out = [mixed & ~np.uint64(1)]
        base = (self.kind[places] * np.uint64(8) + self.words[places]) * np.uint64(2) + self.script[places]
        mixed = (base + np.uint64(1)) * _MULTIPLIER
        for back in range(max(ORDERS)):
            mixed = (mixed ^ self.classes[np.maximum(places - back, 0)]) * _MULTIPLIER
            mixed ^= mixed >> np.uint64(29)
            if back + 1 in ORDERS:
                out.append((mixed + np.uint64(back)) & ~np.uint64(1))
        return out


def _chunks(batches: Iterator[pa.RecordBatch], characters: int = 2_000_000) -> Iterator[tuple[list, list[str]]]:
    """(first columns' values, texts) of rows that hold about so many characters together; texts come last."""
    rows, texts, size = [], [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            rows.append(row[:-1])
            texts.append(row[-1])
            size += len(row[-1])
            if size >= characters:
                yield rows, texts
                rows, texts, size = [], [], 0
    if texts:
        yield rows, texts


def _inner(known: Filter) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How often the text went on, or a sentence ended, after each context inside of texts that is ``known``.

    A sentence ends after its point; in Hangul, where the predicate shows it, before it, too. Before a
    line break, neither is known.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches):
            c = Contexts(texts)
            codes, n = c.codes, len(c.codes)
            after = np.zeros(n, dtype=np.uint32)
            after[:-1] = codes[1:]
            beyond = np.zeros(n, dtype=np.uint32)
            beyond[:-2] = codes[2:]
            plain = (codes != 32) & (codes != 10) & (codes != 0) & (after != 10) & (after != 0)
            places = np.flatnonzero(plain)
            points, white = [46, 33, 63, 0x3002], [32, 10, 0]
            before = np.isin(after[places], points) & np.isin(beyond[places], white) & (c.script[places] == 1)
            stop = (before | (np.isin(codes[places], points) & (after[places] == 32))).astype(np.uint64)
            for keys in c.keys(places):
                at = known.holds(keys)
                found, many = np.unique(keys[at] | stop[at], return_counts=True)
                ended = (found & np.uint64(1)).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((found & ~np.uint64(1)).view(np.int64)), pa.array(np.where(ended, many, 0)), pa.array(np.where(ended, 0, many))], names=["context", "ended", "went_on"]
                )

    return count


def _final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The final contexts of texts, by digest. Blank texts are left out; ``bare`` ones are nothing but a mark."""
    for rows, texts in _chunks(batches):
        ends = [without_mark(t) for t in texts]
        keep = [i for i, (t, e) in enumerate(zip(texts, ends, strict=True)) if e or t.strip()]
        rows, bare = [rows[i] for i in keep], [not ends[i] for i in keep]
        c = Contexts([ends[i] or " " for i in keep])
        last = c.ends - 1
        keys = c.keys(last)
        a, b = (pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([a, b, pa.array(bare), pa.array(c.script[last].astype(np.int32)), *[pa.array(k.view(np.int64)) for k in keys]], names=["a", "b", "bare", "hangul", *[f"k{i}" for i in range(LEVELS)]])


def end_scores(docs: DataFrame, text: str = "text", weight: float = 8.0) -> DataFrame:
    """(``a``, ``b``, ``bare``, ``hangul``, ``log_odds``) of every distinct non-blank text, by its digest.

    The odds compare how likely a text, or a sentence, ends after the text's final characters with how
    likely it goes on. They come from counts over all texts for 3 characters and then, on lines of the same
    kind, of 2, 4 and 6 characters, each level smoothed by the one before with ``weight`` observations. A text's own end does not speak for
    itself, and equal texts count one end.
    """
    digest = [F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text, F.length(text)).alias("b")]
    known = docs.where(F.col(text).isNotNull() & (F.col(text) != "")).select(*digest, F.col(text).alias("t"))
    levels = [f"k{i}" for i in range(LEVELS)]
    final = checkpoint(known.mapInArrow(_final, "a long, b long, bare boolean, hangul int, " + ", ".join(f"{k} long" for k in levels)).dropDuplicates(["a", "b"]))
    each = final.select("a", "b", "bare", "hangul", F.posexplode(F.array(*levels)).alias("level", "context"))
    ends = each.groupBy("context").agg(F.count("*").alias("finals"))
    # Of the contexts inside of texts only those move that some text ends in, but for a few the filter lets through.
    asked = hash_filter(each.select(F.col("context").alias("hash")), each=6)
    inner = known.select("t").mapInArrow(_inner(asked), "context long, ended long, went_on long")
    counts = inner.groupBy("context").agg(F.sum("ended").alias("ended"), F.sum("went_on").alias("went_on"))
    odds = ends.join(counts, "context", "left").select("context", "finals", F.coalesce("ended", F.lit(0)).alias("ended"), F.coalesce("went_on", F.lit(0)).alias("went_on"))
    scored = each.join(odds, "context").groupBy("a", "b", "bare", "hangul").agg(F.sort_array(F.collect_list(F.struct("level", "finals", "ended", "went_on"))).alias("levels"))
    p = F.lit(0.05)
    for i in range(LEVELS):
        level = F.col("levels")[i]
        end = level["finals"] - 1 + level["ended"]
        p = (end + weight * p) / (end + level["went_on"] + weight)
    return scored.select("a", "b", "bare", "hangul", F.log((p + 1e-12) / (1 - p + 1e-12)).alias("log_odds"))


def threshold(histogram: dict[float, int], rounds: int = 200) -> float:
    """The log-odds below which a text is more likely cut than not, given how many texts have which.

    The odds of a cut are the share of cut texts against that of whole ones, over the odds of an end. The
    share is not known: it starts at one half and becomes the mean probability of a cut that follows
    from it, until it stays. It is at least that of a single text.
    """
    values, many = np.array(list(histogram)), np.array(list(histogram.values()), dtype=float)
    least, share = 1 / (many.sum() + 2), 0.5
    for _ in range(rounds):
        limit = math.log(share / (1 - share))
        new = min(1 - least, max(least, float((many / (1 + np.exp(np.clip(values - limit, -500, 500)))).sum() / max(many.sum(), 1))))
        if abs(new - share) < 1e-9:
            break
        share = new
    return math.log(share / (1 - share))


def thresholds(scores: DataFrame) -> dict[int, float]:
    """The threshold of every script (1 for Hangul) of one column, from the ends of all its distinct texts."""
    step = F.round(F.greatest(F.lit(-60.0), F.least(F.lit(60.0), "log_odds")) * 10) / 10
    counted = scores.where(~F.col("bare")).groupBy("hangul", step.alias("step")).agg(F.count("*").alias("many")).collect()
    by_script: dict[int, dict[float, int]] = {}
    for row in counted:
        by_script.setdefault(row["hangul"], {})[row["step"]] = row["many"]
    return {script: threshold(found) for script, found in by_script.items()}


def truncated(docs: DataFrame, key: str = "doc_id", text: str = "text", least: dict[int, float] | None = None) -> DataFrame:
    """Every row's key with ``log_odds`` and whether it is ``truncated``; other columns of ``docs`` are kept.

    The threshold of each script (``least``: of texts in Latin script at 0, in Hangul at 1) is fitted to
    the scores of this column unless given. Null, empty and blank texts have no end to be judged: their
    log-odds are null and they are not truncated. Texts that consist of a mark only are truncated.
    """
    scores = end_scores(docs, text)
    if least is None:
        scores = checkpoint(scores)
        least = thresholds(scores)
    limit = F.when(F.col("hangul") == 1, least.get(1, 0.0)).otherwise(least.get(0, 0.0))
    scores = scores.select(F.col("a").alias("__a"), F.col("b").alias("__b"), F.when(~F.col("bare"), F.col("log_odds")).alias("__odds"), (F.col("bare") | (F.col("log_odds") < limit)).alias("__cut"))
    keyed = docs.withColumn("__a", F.xxhash64(text)).withColumn("__b", F.xxhash64(F.lit(7), text, F.length(text)))
    joined = keyed.join(scores, ["__a", "__b"], "left")
    kept = [F.col(c) for c in docs.columns if c not in ("log_odds", "truncated")]
    return joined.select(*kept, F.col("__odds").alias("log_odds"), F.coalesce("__cut", F.lit(False)).alias("truncated"))


def truncation_rates(docs: DataFrame, source: str = "source", **options) -> DataFrame:
    """``documents``, ``cut`` and ``share`` for every value of the source column; null is a source."""
    judged = truncated(docs, **options)
    cut = F.sum(F.col("truncated").cast("long"))
    return judged.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("documents"), cut.alias("cut"), (cut / F.count("*")).alias("share"))
