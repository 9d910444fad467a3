"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources that they belong to (their pattern). A flow from
patterns to sources routes words to the sources' quotas: each repetition of a pattern's words is an
arc of its own whose cost rises with the repetition (a convex cost), so fresh words go first and
repetition is spread. Seeded selection then turns each pattern's words into documents.

Sources that no pattern joins, directly or over others, have flows of their own, so a table of single
sources costs one small flow each. Only the totals by pattern reach the driver, MAX_PATTERNS at most; a table
with more is refused. A flow of n patterns over sources that all hang together takes about n * n * 13
microseconds (2000 patterns: 51 s), so that is the real limit for overlapping sources.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, table, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
MAX_PATTERNS = 100_000
#: Rows of a pattern that are put in order together, in the mean.
BUCKET_ROWS = 50_000
#: Rows alike that one task writes.
COPIES = 1 << 20
_KEY_BITS = 60
SEED = "mix"


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = EPOCHS) -> list[float]:
    """Shares of total by weight; none above most times its size, the excess reshared by weight."""
    caps = [most * s for s in sizes]
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > caps[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = float(caps[i])
            open_.discard(i)
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
    return out


def joined(patterns: Sequence[tuple[Sequence[int], int]], sources: int) -> list[tuple[list[int], list[int]]]:
    """The patterns, and the sources, that hang together."""
    parent = list(range(sources))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for own, _ in patterns:
        for s in own:
            parent[root(s)] = root(own[0])
    parts: dict[int, tuple[list[int], list[int]]] = {}
    for s in range(sources):
        parts.setdefault(root(s), ([], []))[1].append(s)
    for p, (own, _) in enumerate(patterns):
        parts[root(own[0])][0].append(p)
    return list(parts.values())


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], epochs: int = EPOCHS) -> dict[tuple[int, int], int]:
    """Min-cost flow: words of pattern p that go to source s, as {(p, s): words}.

    patterns: sources and size of each. Repetition k of a pattern costs k a word. What hangs together is
    routed by itself.
    """
    out = {}
    for ps, ss in joined(patterns, len(quotas)):
        place = {s: i for i, s in enumerate(ss)}
        flow = _flow([([place[s] for s in patterns[p][0]], patterns[p][1]) for p in ps], [quotas[s] for s in ss], epochs)
        out |= {(ps[p], ss[s]): words for (p, s), words in flow.items()}
    return out


def _flow(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], epochs: int) -> dict[tuple[int, int], int]:
    """route, by successive shortest paths with potentials; all costs are small whole numbers."""
    n, m = len(patterns), len(quotas)
    sink = n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(sink + 1)]  # arcs: to, room, cost, place of the reverse arc

    def arc(a: int, b: int, room: int, cost: int) -> list[int]:
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])
        return graph[a][-1]

    flows = {}
    for p, (sources, size) in enumerate(patterns):
        for k in range(epochs):
            arc(0, 1 + p, size, k)
        for s in sources:
            flows[p, s] = (arc(1 + p, 1 + n + s, epochs * size, 0), epochs * size)
    for s, quota in enumerate(quotas):
        arc(1 + n + s, sink, quota, 0)
    price = [0] * (sink + 1)
    while True:
        far, via = [1 << 60] * (sink + 1), [None] * (sink + 1)
        far[0], todo = 0, [(0, 0)]
        while todo:
            d, a = heapq.heappop(todo)
            if d > far[a]:
                continue
            for k, (b, room, cost, _) in enumerate(graph[a]):
                if room > 0 and (x := d + cost + price[a] - price[b]) < far[b]:
                    far[b], via[b] = x, (a, k)
                    heapq.heappush(todo, (x, b))
        if via[sink] is None:
            break
        price = [p + min(d, far[sink]) for p, d in zip(price, far)]
        path, b = [], sink
        while b:
            a, k = via[b]
            path.append((a, k))
            b = a
        room = min(graph[a][k][1] for a, k in path)
        for a, k in path:
            graph[a][k][1] -= room
            graph[graph[a][k][0]][graph[a][k][3]][1] += room
    return {k: all_ - x[1] for k, (x, all_) in flows.items() if all_ > x[1]}


def sized(docs: DataFrame) -> DataFrame:
    """docs with size, the number of words of its text (null: 0), as a long."""
    return docs.withColumn("size", F.regexp_count(text_of(), F.lit(f"({WORD})")).cast("long"))


def mix(sizes: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: str = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """Words taken of each row. sizes: doc_id, sources (array of strings), size.

    Columns of sizes named in carry come along; they tell rows alike in doc_id and size apart, and the
    first of them stands in for a doc_id that is null.

    Adds source_size and target (both of the first of its sources) and taken, the words that the mix
    takes of the row, repetitions counted: 0 to epochs times its size. Sources are ranked by code
    point with null last and weigh ``weights`` in turn. Within a pattern whole documents are taken in
    the order of md5(seed:doc_id), each row in its own place, and one document is cut to meet the
    pattern's words exactly. Rows alike in doc_id are ordered by size; rows alike in all columns are
    counted before the shuffle and share a place, one after another. Empty arrays and nulls count as the
    null source; size 0 takes 0, however long a text is only its size counts; no rows, no rows. Reruns
    agree.
    """
    named = F.coalesce(*(F.col(c).cast("string") for c in ("doc_id", *carry[:1])), F.lit(""))
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named).cast("binary")), 1, _KEY_BITS // 4), 16, 10).cast("long")
    own = F.when(F.size(F.coalesce("sources", F.array())) > 0, F.array_sort(F.array_distinct("sources"))).otherwise(F.array(F.lit(None).cast("string")))
    d = sizes.select("doc_id", "size", own.alias("sources"), key.alias("key"), *carry)
    d = table(d.groupBy(*d.columns).agg(F.count("*").alias("copies")), "mix-sizes")
    all_ = F.col("size") * F.col("copies")
    rows = d.groupBy("sources").agg(F.sum(all_).alias("size"), F.count("*").alias("n"), F.max("copies").alias("most")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    rows = sorted(rows, key=lambda r: [(s is None, s or "") for s in r["sources"]])
    names = sorted({s for r in rows for s in r["sources"]}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    source_size = [0] * len(names)
    for r in rows:
        for s in r["sources"]:
            source_size[place[s]] += r["size"]
    # a word of an overlapping pattern counts once in what is shared out
    goal = targets(source_size, [weights[i % len(weights)] for i in range(len(names))], share * sum(r["size"] for r in rows), epochs)
    flow = route([([place[s] for s in r["sources"]], r["size"]) for r in rows], [round(x) for x in goal], epochs)
    words = [sum(flow.get((p, place[s]), 0) for s in r["sources"]) for p, r in enumerate(rows)]
    plan = d.sparkSession.createDataFrame(
        [(r["sources"], r["size"], source_size[place[r["sources"][0]]], goal[place[r["sources"][0]]], w // r["size"] if r["size"] else 0, w % r["size"] if r["size"] else 0) for r, w in zip(rows, words)],
        "sources array<string>, pattern_size long, source_size long, target double, rounds long, rest long",
    )
    plan = table(plan.withColumn("pattern", F.xxhash64(F.to_json("sources"))), "mix-plan")
    bits = min(_KEY_BITS, (max((r["n"] for r in rows), default=0) // BUCKET_ROWS).bit_length())
    d = d.withColumns({"pattern": F.xxhash64(F.to_json("sources")), "bucket": F.shiftright("key", _KEY_BITS - bits)})
    # the words before a bucket come from totals by bucket; only rows of one bucket of one pattern are put in order
    total = d.groupBy("pattern", "bucket").agg(F.sum(all_).alias("n"))
    before = total.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    plan = before.join(plan, "pattern").select("pattern", "bucket", "before", "source_size", "target", "rounds", "rest")
    order = Window.partitionBy("pattern", "bucket").orderBy("key", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("ahead", F.coalesce(F.sum(all_).over(order), F.lit(0))).join(plan, ["pattern", "bucket"])
    d = d.withColumn("left", F.greatest(F.col("rest") - F.col("before") - F.col("ahead"), F.lit(0)))
    if max((r["most"] for r in rows), default=0) > COPIES:
        d = d.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES)))).repartition("key", "from")
    else:
        d = d.withColumn("from", F.lit(0).cast("long"))
    d = d.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + COPIES, "copies") - 1)))
    extra = F.least(F.greatest(F.col("left") - F.col("copy") * F.col("size"), F.lit(0)), F.col("size"))
    return d.select("doc_id", "sources", "size", "source_size", "target", (F.col("rounds") * F.col("size") + extra).alias("taken"), *carry)


def single_source(col: str | Column = "source") -> Column:
    """The sources of a table in which each row has one."""
    return F.array(F.col(col) if isinstance(col, str) else col)
