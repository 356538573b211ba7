"""Evaluation texts that leak into training text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.cluster import broadcast_if_small, checkpoint
from corpusloom.llm.filters import Filter, hash_filter

_OTHER = re.compile(r"[\W_]+")
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}

#: Least length of a repeated run, in letters and digits, by language.
RUNS = {"ko": 26, "en": 44}


def signs(text: str | None) -> str:
    """The letters and digits of a text in lower case."""
    return _OTHER.sub("", text.lower()) if text else ""


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@lru_cache(maxsize=1)
def _kept() -> np.ndarray:
    """Which characters are letters or digits; the zero that parts texts stays, too."""
    kept = np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool, count=0x110000)
    kept[0] = True
    return kept


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(str(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        _POWERS[str(base)] = known = np.cumprod(known)
    return known[:n]


class Windows:
    """Hashes of all windows of a string: the sum of c(j) B^j over a window, divided by B^start, mod 2^64."""

    def __init__(self, text: str | np.ndarray):
        codes = _codes(text) if isinstance(text, str) else text
        codes = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        codes ^= codes >> np.uint64(32)
        self.n = len(codes)
        self.sums = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum(codes * _powers(_BASE, self.n), out=self.sums[1:])

    def of(self, width: int) -> np.ndarray:
        if self.n < width:
            return np.empty(0, dtype=np.uint64)
        many = self.n - width + 1
        sums = (self.sums[width:] - self.sums[:-width]) * _powers(_INVERSE, many)
        sums ^= sums >> np.uint64(29)
        return sums * np.uint64(0xBF58476D1CE4E5B9)


def needed_shingles(length: int, width: int) -> int:
    """How many of an item's shingles, side by side, stand in a document that repeats half of it.

    A run of r characters holds no fewer than (r - width + 1) / width of them whole.
    """
    return max(1, -(-((length + 1) // 2) // (3 * width - 2)))


def item_shingles(items: DataFrame, runs: dict[str, int]) -> DataFrame:
    """(``u``, ``item_id``, ``flat``, ``run``, ``width``, ``needed``, ``hashes``) of items: their letters and digits, and the
    hashes of their shingles of half a run's length, side by side. Items shorter than a run are left out."""
    kind = dict(items.dtypes)["item_id"]
    once = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).groupBy("item_id", "text").agg(F.max("lang").alias("lang"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keep = [], []
            for i, (text, lang) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                flat = signs(text)
                hangul = sum("가" <= c <= "힣" for c in flat)
                run = runs.get((lang or "").strip().lower()[:2]) or runs["ko" if hangul * 2 > len(flat) else "en"]
                width = run // 2
                if len(flat) >= run:
                    keep.append(i)
                    rows.append((flat, run, width, needed_shingles(len(flat), width), Windows(flat).of(width)[::width].view(np.int64)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["u", "item_id", "flat", "run", "width", "needed", "hashes"])

    return once.select(F.xxhash64("item_id", "text").alias("u"), "item_id", "text", "lang").mapInArrow(cut, f"u long, item_id {kind}, flat string, run int, width int, needed int, hashes array<long>")


def covered(doc: str, item: str, run: int, windows: np.ndarray, times: int = 3, share: float = 0.5) -> bool:
    """Whether a stretch of ``doc`` of at most ``times`` the item repeats ``share`` of it in runs of ``run``."""
    own = Windows(item).of(run)
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    low, high = np.searchsorted(ranked, windows, "left"), np.searchsorted(ranked, windows, "right")
    at = np.flatnonzero(high > low)
    pairs = [(int(q), int(p)) for q in at for p in order[low[q] : high[q]] if doc.startswith(item[p : p + run], q)]
    need = share * len(item)

    def total(part: list[tuple[int, int]]) -> int:
        seen = np.zeros(len(item) + 1, dtype=np.int64)
        for _, p in part:
            seen[p] += 1
            seen[p + run if p + run <= len(item) else len(item)] -= 1
        return int((np.cumsum(seen)[:-1] > 0).sum())

    if not pairs or total(pairs) < need:
        return False
    room = times * len(item) - run
    if pairs[-1][0] - pairs[0][0] <= room:
        return True
    known = {(q, p) for q, p in pairs}
    places = [q for q, _ in pairs]
    for i, (q, p) in enumerate(pairs):
        if (q - 1, p - 1) in known:  # a run's first window is its best start, unless the stretch ends first
            if places[-1] <= q + room:
                continue
        end = np.searchsorted(places, q + room, "right")
        if total(pairs[int(np.searchsorted(places, q, "left")) : end]) >= need:
            return True
    return False


def found_windows(docs: DataFrame, known: Filter, widths: list[int]) -> DataFrame:
    """(``u``, ``width``, ``hash``, ``place``) of windows in (``u``, ``text``) that the filter holds. One pass, a few texts at a time."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _kept()
        for batch in batches:
            names, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (size < 400_000 or end == at):
                    size += len(texts[end]) + 1
                    end += 1
                codes = _codes("\0".join(t.replace("\0", " ") for t in texts[at:end]).lower() + "\0")
                codes = codes[kept[codes]]
                begins = np.concatenate([[0], np.flatnonzero(codes == 0) + 1])
                windows = Windows(codes)
                for width in widths:
                    own = windows.of(width)
                    where = known.holds(own)
                    row = np.searchsorted(begins, where, "right") - 1
                    inside = where + width < begins[row + 1]
                    where, row = where[inside], row[inside]
                    if len(where):
                        columns = [names[at:end][row], np.full(len(where), width, np.int32), own[where].view(np.int64), (where - begins[row]).astype(np.int32)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["u", "width", "hash", "place"])
                at = end

    return docs.select("u", "text").mapInArrow(find, "u long, width int, hash long, place int")


def prefixes(shingles: DataFrame, frequency: DataFrame) -> DataFrame:
    """(``width``, ``hash``, ``item``): of each item's shingles, ordered by rarity, those that a match cannot do
    without: all but ``needed`` - 1."""
    rarest = Window.partitionBy("item").orderBy(F.coalesce("many", F.lit(0)), "hash", "start")
    ranked = shingles.join(frequency, ["width", "hash"], "left").withColumn("rank", F.row_number().over(rarest))
    return ranked.where(F.col("rank") <= F.col("shingles") - F.col("needed") + 1).select("width", "hash", "item").distinct()


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", runs: dict[str, int] | None = None, max_broadcast: int = 1_000_000) -> DataFrame:
    """(``key``, ``item_id``) of every document of which a stretch repeats at least half of an item.

    Letters and digits count, in lower case, in repeated runs of a length set by the item's language
    (by its script where that is missing; of several languages given for one text the greatest); the
    stretch is no longer than three times the item. Null and empty documents and items, and items shorter
    than a run, match nothing. Repeated documents are reported under each key; repeated rows once.
    Clashing names do no harm: only the key and text, and of the items ``item_id``, ``text`` and ``lang``,
    are read.

    Items are a table of shingles. One pass over the documents gives the windows that a bounded filter of
    these lets through; windows and shingles are equality-joined. How many documents have a shingle is
    counted from these, the rare ones that a match needs give the candidates, number and position of all
    hits bound them, and the rest is verified by its texts. Neither table is ever on the driver, and the
    number of passes does not depend on the number of items.
    """
    runs = runs or RUNS
    cut = checkpoint(item_shingles(items, runs))
    each = cut.select(F.col("u").alias("item"), "width", "needed", F.size("hashes").alias("shingles"), F.length("flat").alias("length"), F.posexplode("hashes").alias("pos", "hash"))
    shingles = each.withColumn("start", F.col("pos") * F.col("width"))
    known = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(key, text).alias("u"), F.col(text).alias("text"))
    hits = checkpoint(found_windows(known, hash_filter(shingles), sorted({r // 2 for r in runs.values()})).join(shingles.select("width", "hash").distinct(), ["width", "hash"], "left_semi").distinct())
    frequency = hits.select("width", "hash", "u").distinct().groupBy("width", "hash").agg(F.count("*").alias("many"))
    candidates = hits.join(prefixes(shingles, frequency), ["width", "hash"]).select("u", "item").distinct()
    matched = hits.join(shingles, ["width", "hash"]).join(candidates, ["u", "item"], "left_semi")
    placed = matched.groupBy("u", "item").agg(F.count_distinct("start").alias("starts"), F.sort_array(F.collect_list("place")).alias("places"), F.first("needed").alias("needed"), F.first("length").alias("length"))
    # Within some stretch of three times the item there are as many hits as needed.
    near = F.expr("exists(sequence(0, greatest(0, size(places) - needed)), i -> get(places, i + needed - 1) - get(places, i) <= 3 * length)")
    pairs = checkpoint(placed.where((F.col("starts") >= F.col("needed")) & near).select("u", "item"))
    few, _ = broadcast_if_small(pairs, max_broadcast)
    texts = known.join(few, "u").join(cut.select(F.col("u").alias("item"), "item_id", "flat", "run"), "item")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, doc, windows = [], None, "", {}
            for i, (body, item, run) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
                if body != last:
                    last, doc, windows = body, signs(body), {}
                if run not in windows:
                    windows[run] = Windows(doc).of(run)
                if covered(doc, item, run, windows[run]):
                    keep.append(i)
            found = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([found.column(0), found.column(1)], names=[key, "item_id"])

    return texts.select("key", "item_id", "text", "flat", "run").mapInArrow(verify, f"{key} {dict(docs.dtypes)[key]}, item_id {dict(items.dtypes)['item_id']}").distinct()
