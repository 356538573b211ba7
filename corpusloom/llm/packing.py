"""Filling containers of several permitted sizes with items, with little unused space."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusloom.cluster import broadcast_if_small, checkpoint
from corpusloom.llm.tokens import TOKENIZERS, VOCABULARY, token_count


def _filled(capacity: int, sizes: list[int], left: dict[int, int]) -> int:
    """How much of a container the largest items that still fit would fill. ``sizes`` ascend."""
    room, end = capacity, len(sizes)
    while room and (end := bisect_right(sizes, room, 0, end)):
        size = sizes[end - 1]
        room -= size * min(left[size], room // size)
        end -= 1
    return capacity - room


def plan(histogram: dict[int, int], capacities: list[int], overhead: int = 64) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Best-fit decreasing over a histogram of sizes, many equal items at a time.

    Returns slots (size, first rank, items, items a container, first container): of the items of a size,
    numbered from 0, those from the first rank on go to consecutive containers; and containers (first,
    how many, capacity), each downsized to the least permitted capacity that holds its contents.

    Items go to the containers with the least room that takes them. Where none does, containers of the
    capacity are opened that costs least for each unit that the items still left could fill it with. A
    container costs its capacity and a fixed ``overhead``, so small ones are opened only where large ones
    would stay partly empty; of equal ones, the largest.
    """
    capacities = sorted(capacities)
    left = {s: n for s, n in histogram.items() if s > 0 and n > 0}
    sizes = sorted(left)
    groups: list[tuple[int, int, int, int]] = []  # room, first container, how many, capacity; ascending
    slots, opened = [], 0
    while sizes:
        size = sizes[-1]
        rank, items = 0, left[size]
        while items:
            at = bisect_right(groups, (size, -1, 0, 0))
            if at < len(groups):
                room, first, many, capacity = groups.pop(at)
            else:
                left[size] = items
                capacity = min((c for c in capacities if c >= size), key=lambda c: ((c + overhead) / _filled(c, sizes, left), -c))
                room, first = capacity, opened
                many = -(-items // (capacity // size))
                opened += many
            each = room // size
            full, rest = divmod(min(items, many * each), each)
            slots.append((size, rank, full * each + rest, each, first))
            rank, items = rank + full * each + rest, items - full * each - rest
            if full:
                insort(groups, (room - each * size, first, full, capacity))
            if rest:
                insort(groups, (room - rest * size, first + full, 1, capacity))
            if many > full + (rest > 0):
                insort(groups, (room, first + full + (rest > 0), many - full - (rest > 0), capacity))
        sizes.pop()
        del left[size]
    shrunk = [(first, many, next(c for c in capacities if c >= capacity - room)) for room, first, many, capacity in groups]
    return slots, sorted(shrunk)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacities: tuple[int, ...] = (256, 512, 1024, 2048), buckets: int | None = None, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Puts every document into containers sized in tokens.

    One row per document or piece: key, ``piece_no`` (from 0), ``start_token``, ``tokens``,
    ``container_no``, ``container_size``. A document is split only if it is longer than the greatest
    capacity; all its pieces but the last then fill a container. Null and empty texts have 0 tokens and
    no container (null). Repeated rows are items of their own; their order among equals is arbitrary,
    what is packed is not. Columns other than the two named are not read. No rows: no containers.

    The plan needs no more than the histogram of sizes, of at most as many rows as the greatest
    capacity, and is exact for any number of items. Items find their slot by their rank among the items
    of their size; ranks are counted in ``buckets`` hash buckets a size (as many as leave some 50,000 items of
    the commonest size in each, unless given), so that a size that a third of all items have does not end in
    one task. Slots and spans are bounded by the number of sizes,
    whatever that of items; they are broadcast if they are as few as that.
    """
    largest = max(capacities)
    counted = docs.select(F.col(key).alias("key"), token_count(F.col(text), folder, vocabulary).alias("n"))
    pieces = counted.select("key", "n", F.posexplode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / largest) - 1).cast("int"))).alias("pos", "piece_no"))
    size = F.least(F.lit(largest), F.col("n") - F.col("piece_no") * largest).cast("int")
    # Tokenized once: the histogram and the assignment read the same written sizes.
    sized = checkpoint(pieces.select("key", "piece_no", size.alias("size")))
    histogram = {r["size"]: r["many"] for r in sized.groupBy("size").agg(F.count("*").alias("many")).collect()}
    buckets = buckets or max(16, -(-max(histogram.values(), default=0) // 50_000))
    items = sized.withColumn("bucket", F.pmod(F.xxhash64("key", "piece_no"), F.lit(buckets)).cast("int"))
    cells = items.groupBy("size", "bucket").agg(F.count("*").alias("many"))
    slots, containers = plan(histogram, list(capacities))

    spark = docs.sparkSession
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("size", "bucket", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("size", "bucket").orderBy("key", "piece_no")) - 1
    ranked = items.withColumn("inside", inside).join(offsets, ["size", "bucket"]).withColumn("rank", F.col("inside") + F.col("offset"))
    slot = spark.createDataFrame(slots or [(-1, 0, 0, 1, 0)], "size int, first_rank long, items long, each long, first long")
    placed = ranked.join(broadcast_if_small(slot, 8 * largest)[0], "size", "left").where(F.col("first_rank").isNull() | ((F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("items"))))
    number = F.col("first") + ((F.col("rank") - F.col("first_rank")) / F.col("each")).cast("long")
    # A container's size follows from its fill; the containers of one slot may differ in theirs.
    firsts = [c[0] for c in containers]
    parts = []
    for size_, rank, many, each, first in slots:
        end = first + -(-many // each)
        for c in range(bisect_right(firsts, first) - 1, bisect_left(firsts, end)):
            parts.append((size_, rank, *containers[c]))
    spans = spark.createDataFrame(parts or [(-1, 0, 0, 1, 0)], "size int, first_rank long, c_first long, c_many long, container_size int")
    numbered = placed.withColumn("container_no", number)
    sized = numbered.join(broadcast_if_small(spans, 8 * largest)[0], ["size", "first_rank"], "left").where(F.col("container_no").isNull() | ((F.col("container_no") >= F.col("c_first")) & (F.col("container_no") < F.col("c_first") + F.col("c_many"))))
    return sized.select(F.col("key").alias(key), "piece_no", (F.col("piece_no").cast("long") * largest).alias("start_token"), F.col("size").alias("tokens"), "container_no", "container_size")
