"""Problem 8: documents in containers of fixed capacity, with little room left over.

Only sizes decide a packing, and there are at most as many sizes as a container has tokens. So the sizes are counted on
the cluster, and the plan is made from that histogram: sets of sizes that dominate all alternatives (Martello and Toth)
are fixed, the rest is placed by best fit in decreasing order. The plan says how many containers of each pattern there
are; documents find their place by their rank among documents of their size, which is computed in salted buckets.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64  # parts in which documents of one size are ranked
Pattern = tuple[tuple[int, int], ...]  # (size, how many), largest size first


class _Sizes:
    """A multiset of sizes with the largest size up to a bound, by a sorted list of at most `capacity` distinct sizes."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.order = sorted(self.n)

    def take(self, size: int, many: int) -> None:
        self.n[size] -= many
        if not self.n[size]:
            del self.n[size]
            self.order.remove(size)

    def upto(self, bound: int) -> int | None:
        at = bisect_right(self.order, bound)
        return self.order[at - 1] if at else None

    def smallest(self, many: int, without: Counter) -> list[int]:
        """The sizes of the `many` smallest items besides those in `without`."""
        out: list[int] = []
        for s in self.order:
            free = self.n[s] - without.get(s, 0)
            out += [s] * min(free, many - len(out))
            if len(out) == many:
                break
        return out


def reduce_dominated(sizes: dict[int, int], capacity: int) -> tuple[Counter, dict[int, int]]:
    """(fixed patterns with their numbers, remaining sizes): the reduction of Martello and Toth over counted sizes.

    For each size j, largest first: if nothing fits beside it, it stands alone; if its best partner k fills the container,
    or no two items fit beside j, or k is at least as large as any two items that fit, then {j, k} dominates every other
    set with j and is fixed, as often as both are there. Sets of more than three items are left to the rest, as there.
    """
    left, fixed = _Sizes(sizes), Counter()
    for j in sorted(sizes, reverse=True):
        while left.n.get(j):
            free = capacity - j
            two = left.smallest(2, Counter({j: 1}))
            if not two or two[0] > free:
                fixed[((j, 1),)] += left.n[j]
                left.take(j, left.n[j])
                break
            k = left.upto(free)
            if k == j and left.n[j] == 1:
                at = left.order.index(j)
                k = left.order[at - 1] if at else None
            if k is None:
                break
            three = left.smallest(3, Counter({j: 1}))
            pair_fits = len(two) == 2 and sum(two) <= free
            triple_fits = len(three) == 3 and sum(three) <= free
            if not (k == free or not pair_fits or (not triple_fits and k >= _best_pair(left, j, free))):
                break
            # the same choice holds until one of both sizes runs out
            many = left.n[j] // 2 if k == j else min(left.n[j], left.n[k])
            fixed[((j, 2),) if k == j else ((j, 1), (k, 1))] += many
            left.take(j, 2 * many if k == j else many)
            if k != j:
                left.take(k, many)
    return fixed, dict(left.n)


def _best_pair(left: _Sizes, j: int, free: int) -> int:
    """The largest sum of two items besides one j that fits into free."""
    best, order, low = 0, left.order, 0
    high = bisect_right(order, free) - 1
    while low <= high:
        a, b = order[low], order[high]
        if left.n[b] <= (b == j):  # only j itself
            high -= 1
        elif left.n[a] <= (a == j):
            low += 1
        elif a + b > free:
            high -= 1
        elif a == b:
            return max(best, a + b if left.n[a] - (a == j) > 1 else 0)
        else:
            best = max(best, a + b)
            low += 1
    return best


def best_fit(sizes: dict[int, int], capacity: int) -> Counter:
    """Patterns with their numbers by best fit in decreasing order, over counted sizes.

    Open containers are kept by what is free in them and what they hold, and all containers alike are filled at once.
    """
    opened: dict[int, Counter] = defaultdict(Counter)
    frees: list[int] = []  # sorted keys of opened

    def put(free: int, pattern: Pattern, many: int) -> None:
        if free not in opened:
            insort(frees, free)
        opened[free][pattern] += many

    for w in sorted(sizes, reverse=True):
        n = sizes[w]
        while n:
            at = bisect_left(frees, w)
            if at == len(frees):
                each = capacity // w
                whole, rest = divmod(n, each)
                if whole:
                    put(capacity - each * w, ((w, each),), whole)
                if rest:
                    put(capacity - rest * w, ((w, rest),), 1)
                break
            free = frees[at]
            pattern, there = next(iter(opened[free].items()))
            each = min(free // w, n)
            many = min(there, n // each)
            opened[free][pattern] -= many
            if not opened[free][pattern]:
                del opened[free][pattern]
                if not opened[free]:
                    del opened[free]
                    frees.pop(at)
            put(free - each * w, (*pattern, (w, each)), many)
            n -= many * each
    done: Counter = Counter()
    for held in opened.values():
        done.update(held)
    return done


def plan(sizes: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """(pattern, how many containers) for counted sizes of at most capacity each."""
    fixed, rest = reduce_dominated(sizes, capacity)
    return sorted((fixed + best_fit(rest, capacity)).items(), reverse=True)


_PLAN = T.StructType([T.StructField(name, T.LongType()) for name in ("size", "from_rank", "many", "pattern", "first_container", "each", "offset")])


def pieces(documents: DataFrame, key: str, tokens: str, capacity: int) -> DataFrame:
    """(key, start, size): each document, or where it is larger than capacity, pieces of capacity and what remains."""
    long = F.greatest(F.ceil(F.col(tokens) / F.lit(capacity)), F.lit(1))
    at = F.explode(F.sequence(F.lit(0).cast("long"), long.cast("long") - 1)).alias("_i")
    cut = documents.where(F.col(tokens) > 0).select(F.col(key), F.col(tokens).alias("_t"), at)
    start = F.col("_i") * F.lit(capacity)
    return cut.select(key, start.cast("long").alias("start"), F.least(F.lit(capacity), F.col("_t") - start).cast("long").alias("size"))


def pack(documents: DataFrame, key: str, tokens: str, capacity: int, separator: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """(container, position, key, start, size): where each document, or piece of one, stands.

    Items of a container are parted by `separator` tokens each. Only a document larger than the capacity is divided, and
    each token comes out once. Documents without tokens (null or empty text) take no place. Keys must be unique, as
    document ids are, and at least one token must fit. The driver holds one row per size, at most `capacity` of them,
    however many documents there are.
    """
    spark, room = documents.sparkSession, capacity + separator
    parts = pieces(documents, key, tokens, capacity).withColumn("width", F.col("size") + separator)
    parts = parts.withColumn("bucket", F.pmod(F.xxhash64(key, "start"), F.lit(buckets)))
    counted = parts.groupBy("width", "bucket").agg(F.count("*").alias("n"))
    histogram = {r["width"]: r["n"] for r in counted.groupBy("width").agg(F.sum("n").alias("n")).collect()}
    rows, containers, used = [], 0, Counter()
    for number, (pattern, many) in enumerate(plan(histogram, room)):
        offset = 0
        for width, each in pattern:
            rows.append((width, used[width], each * many, number, containers, each, offset))
            used[width] += each * many
            offset += each
        containers += many
    ranges = spark.createDataFrame(rows, _PLAN)
    before = Window.partitionBy("width").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("width", "bucket", "_before")
    inside = Window.partitionBy("width", "bucket").orderBy(key, "start")
    ranked = parts.withColumn("_rank", F.row_number().over(inside) - 1).join(offsets, ["width", "bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    # one row per size, at most `capacity` rows, so it may be broadcast whatever the number of documents
    listed = ranges.groupBy("size").agg(F.sort_array(F.collect_list(F.struct("from_rank", "many", "first_container", "each", "offset"))).alias("_ranges")).withColumnRenamed("size", "width")
    found = ranked.join(F.broadcast(listed), "width").withColumn("_r", F.expr("element_at(filter(_ranges, r -> r.from_rank <= _rank AND _rank < r.from_rank + r.many), 1)"))
    nth = F.col("_rank") - F.col("_r.from_rank")
    container = (F.col("_r.first_container") + F.floor(nth / F.col("_r.each"))).cast("long")
    return found.select(container.alias("container"), (F.col("_r.offset") + nth % F.col("_r.each")).cast("long").alias("position"), key, "start", "size")


def fill_report(packed: DataFrame, capacity: int, separator: int = 0) -> DataFrame:
    """One row: containers, tokens, room left over, and the least number of containers that the tokens need."""
    total, n = F.sum("size"), F.count("*")
    # every container of the plan holds at least one item and their numbers have no gap
    containers = F.max("container") + 1
    kept = packed.agg(containers.alias("n_containers"), n.alias("n_items"), total.alias("n_tokens"), F.ceil((total + n * separator) / F.lit(capacity + separator)).alias("least_containers"))
    room = F.col("n_containers") * F.lit(capacity) - F.col("n_tokens") - F.lit(separator) * (F.col("n_items") - F.col("n_containers"))
    return kept.withColumn("unused_share", F.round(room / (F.col("n_containers") * F.lit(capacity)), 6))
