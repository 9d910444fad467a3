"""Substring dedup: repeated paragraphs and passages, wherever they stand.

Two kinds of units collide, and both are checked before anything is removed.

* Paragraphs are lines of MIN_WORDS words or more; shorter lines that follow one another are put
  together until they have as many, and what is left over joins the paragraph before it. Only short lines
  that stand alone between long or blank ones (headings) and shorter texts are no paragraph. Of their
  5-word shingles BANDS bands of BAND_ROWS minima let a pair of similarity 0.8 collide with probability
  0.9998. Colliding wordings are joined, pairs whose exact Jaccard index is 0.8 or more are linked
  (bands.linked: no colliding pair goes unchecked), and of each connected component only the first
  paragraph stays.
* Passages may begin and end inside a line or run over several. Of every WINDOW runs of GRAM words the one
  of the smallest hash is an anchor, so two documents that share GRAM + WINDOW - 1 = 50 words share an
  anchor. Every occurrence of an anchor meets the first one (never all pairs) and is a repeated passage of
  GRAM words by itself, whatever other documents hold. (Where a document itself repeats an anchor, the later
  ones meet the one before them.) Anchors that always stand together, with the same words between them, meet
  it by their outermost two only. Anchors that meet the same document at the same shift make a run; the run
  must have the same 128-bit digest in both documents and is then extended word by word, at most WINDOW - 1 words to either side, as far as the texts agree. Between two anchors of a
  passage at most one word is not of either, so with the extension the whole passage goes, but for words at
  its ends if the end's anchor stands still earlier in a third document that shares no more than it.
  Passages of fewer than GRAM words that are no paragraph (headings, short licence lines) always stay.

Documents come in the order of (doc_id, hash of the text). A removed span has an earlier copy, exact or,
for the paragraphs, alike: the first copy of any passage stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bands
from tidemark.llm.bands import SHINGLE, SIMILARITY, grams, powers, prefixes, word_hashes
from tidemark.llm.common import BROADCAST_ROWS, checked, components, drop, table, within

MIN_WORDS = 20
BANDS, BAND_ROWS = 12, 3
GRAM, WINDOW = 25, 26
_PLACES = np.uint64((1 << 24) - 1)
_ID = "doc_id long, th long"
#: Stands for a missing id, after all others; such documents are told apart by their texts.
NO_ID = (1 << 63) - 1


def anchors(g: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest hash (its upper 40 bits) of each window, of equal ones the rightmost; of
    fewer hashes, one."""
    if not len(g):
        return np.zeros(0, np.int64)
    low = (g & ~_PLACES) | (_PLACES - (np.arange(len(g), dtype=np.uint64) & _PLACES))
    wide = min(window, len(g))
    held = 1
    while held < wide:  # low[i] is the least of held hashes from i on
        step = min(held, wide - held)
        low = np.minimum(low[:-step], low[step:])
        held += step
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    place = (_PLACES - (low[first] & _PLACES)).astype(np.int64)
    return first + ((place - first) & int(_PLACES))


def paragraphs(lengths: list[int]) -> list[tuple[int, int]]:
    """First word and stop of each paragraph of a text whose lines have so many words."""
    out: list[tuple[int, int]] = []
    at = begin = 0
    joins = False  # whether words left over belong to the paragraph before them
    for n in lengths:
        if n >= MIN_WORDS or not n:
            if joins and begin < at:
                out[-1] = (out[-1][0], at)
            if n:
                out.append((at, at + n))
            at += n
            begin, joins = at, False
        else:
            at += n
            if at - begin >= MIN_WORDS:
                out.append((begin, at))
                begin, joins = at, True
    if joins and begin < at:
        out[-1] = (out[-1][0], at)
    return out


def links(p: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the words from each anchor's first to the next anchor's last; p: prefix hashes."""
    if len(at) < 2:
        return np.zeros(0, np.uint64)
    stop = at[1:] + GRAM
    wide = stop - at[:-1]
    return bands.mixed(p[stop] - p[at[:-1]] * powers(int(wide.max()) + 1)[wide])


def repeats(key: np.ndarray, at: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """last and last_ahead: place of each anchor's occurrence before it in the same text (-1: none), and
    the hash of the words before that."""
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    last, last_ahead = np.full(len(at), -1, np.int64), np.zeros(len(at), np.int64)
    last[order[same + 1]], last_ahead[order[same + 1]] = at[order[same]], ahead[order[same]]
    return last, last_ahead


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def _documents(docs: DataFrame) -> DataFrame:
    d = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.select("doc_id", F.xxhash64("text").alias("th"), "text")


def units(docs: DataFrame) -> DataFrame:
    """doc_id, th, anchors (key, at: its first word, ahead: hash of the words before it, before and
    behind: links to the anchors beside it, 0 for none, last and last_ahead: see repeats) and paragraphs (start, stop, h1 and h2: its digest, keys: of its bands) of each text of MIN_WORDS words or more."""

    def one(text: str):
        lines = [line.split() for line in text.encode().split(b"\n")]
        words = [w for line in lines for w in line]
        if len(words) < MIN_WORDS:
            return None
        p = prefixes(word_hashes(words))
        g = grams(p, GRAM)
        at = anchors(g)
        spans = paragraphs([len(line) for line in lines])
        digests = np.frombuffer(b"".join(_digest(words[a:b]) for a, b in spans), np.int64).reshape(-1, 2)
        link = np.concatenate([[0], links(p, at).view(np.int64), [0]])
        key, ahead = g[at].view(np.int64), p[at].view(np.int64)
        return key, at, ahead, link[: len(at)], link[1 : len(at) + 1], *repeats(key, at, ahead), np.array(spans, np.int64).reshape(-1, 2), digests, grams(p, SHINGLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, bands.SLICE):
                own = b.slice(k, bands.SLICE)
                got = [one(t) for t in own.column(2).to_pylist()]
                which = [i for i, x in enumerate(got) if x]
                if not which:
                    continue
                key, at, ahead, before, behind, last, last_ahead, spans, digests, g = zip(*(got[i] for i in which))
                base = np.cumsum([0, *map(len, g)])
                cuts = np.concatenate([s + [0, 1 - SHINGLE] + o for s, o in zip(spans, base)]).ravel()
                keys = bands.band_keys(np.concatenate(g), cuts, BANDS, BAND_ROWS)
                cat = lambda parts: pa.array(np.concatenate(parts))
                a = pa.StructArray.from_arrays([cat(x) for x in (key, at, ahead, before, behind, last, last_ahead)], ["key", "at", "ahead", "before", "behind", "last", "last_ahead"])
                span, digest = np.concatenate(spans), np.concatenate(digests)
                p = [pa.array(x) for x in (span[:, 0], span[:, 1], digest[:, 0], digest[:, 1])]
                p = pa.StructArray.from_arrays([*p, bands.lists(keys, pa.array(keys.ravel()))], ["start", "stop", "h1", "h2", "keys"])
                yield pa.RecordBatch.from_arrays([own.column(0).take(pa.array(which)), own.column(1).take(pa.array(which)), bands.lists(key, a), bands.lists(spans, p)], ["doc_id", "th", "anchors", "paragraphs"])

    schema = f"{_ID}, anchors array<struct<key:long,at:long,ahead:long,before:long,behind:long,last:long,last_ahead:long>>, paragraphs array<struct<start:long,stop:long,h1:long,h2:long,keys:array<long>>>"
    return _documents(docs).mapInArrow(run, schema)


def _ends(twice: DataFrame) -> DataFrame:
    """key and f (its first doc_id, th, at, ahead) of the anchors that have to meet their first occurrence.

    Where all occurrences of an anchor have the same link behind them, and all of the next anchor the same
    one before them, the two stand together everywhere, and their first occurrences do too. An anchor with
    such links on both sides is left out: its neighbours make the same run without it.
    """
    one = lambda c: F.when((F.min(c) == F.max(c)) & (F.min(c) != 0), F.min(c))
    keys = table(twice.groupBy("key").agg(F.min(F.struct("doc_id", "th", "at", "ahead")).alias("f"), one("before").alias("before"), one("behind").alias("behind")), "anchors-keys")
    solid = table(keys.select(F.col("behind").alias("link")).join(keys.select(F.col("before").alias("link")), "link"), "anchors-links")
    inner = keys.select("key", "before", "behind").join(solid.withColumnRenamed("link", "before"), "before", "left_semi").join(solid.withColumnRenamed("link", "behind"), "behind", "left_semi")
    out = table(keys.select("key", "f").join(inner.select("key"), "key", "left_anti"), "anchors-first")
    drop(keys, solid)
    return out


def _runs(found: DataFrame) -> DataFrame:
    """doc_id, th, start, stop, f_doc, f_th, shift: runs of anchors that all meet the same earlier place."""
    a = found.select("doc_id", "th", F.explode("anchors").alias("a")).select("doc_id", "th", "a.*")
    # which anchors recur is counted before the shuffle; only those are then shuffled with their places
    again = table(a.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "anchors-again")
    twice = table(within(a, again, "key"), "anchors-twice")
    first = _ends(twice)
    # a text's first occurrence of an anchor meets the first of all texts; its later ones need no join
    fresh = twice.where("last < 0").join(first, "key").select("doc_id", "th", F.col("f.doc_id").alias("f_doc"), F.col("f.th").alias("f_th"), (F.col("f.at") - F.col("at")).alias("shift"), "at", "ahead", F.col("f.ahead").alias("f_ahead"))
    own = twice.where("last >= 0").select("doc_id", "th", F.col("doc_id").alias("f_doc"), F.col("th").alias("f_th"), (F.col("last") - F.col("at")).alias("shift"), "at", "ahead", F.col("last_ahead").alias("f_ahead"))
    met = fresh.where("not (doc_id = f_doc and th = f_th and shift = 0)").unionByName(own)
    # rows alike in doc_id and text are combined before the shuffle
    met = table(met.distinct(), "passages-met")
    drop(again, twice, first)
    dealt = met.repartition("doc_id", "th").sortWithinPartitions("doc_id", "th")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(x: np.ndarray) -> pa.RecordBatch:
            x = x[np.lexsort([x[:, k] for k in range(5, -1, -1)])]
            at, ahead, f_ahead = x[:, 5], x[:, 6].view(np.uint64), x[:, 7].view(np.uint64)
            same = (np.diff(x[:, :5], axis=0) == 0).all(axis=1)
            gap = np.where(same, np.diff(at), 0)
            near = powers(int(gap.max(initial=0)) + 1)[gap] if gap.max(initial=0) < 1 << 20 else np.array([pow(int(bands._BASE), int(n), 1 << 64) for n in gap], np.uint64)
            same &= ahead[1:] - ahead[:-1] * near == f_ahead[1:] - f_ahead[:-1] * near
            begins = np.flatnonzero(np.concatenate([[True], ~same]))
            ends = np.concatenate([begins[1:], [len(x)]]) - 1
            cols = [x[begins, 0], x[begins, 1], at[begins], at[ends] + GRAM, x[begins, 2], x[begins, 3], x[begins, 4]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "th", "start", "stop", "f_doc", "f_th", "shift"])

        rest = np.zeros((0, 8), np.int64)
        for b in batches:
            rest = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)])
            cuts = np.flatnonzero((np.diff(rest[:, :2], axis=0) != 0).any(axis=1)) + 1
            if len(cuts):
                yield out(rest[: cuts[-1]])
                rest = rest[cuts[-1] :]
        if len(rest):
            yield out(rest)

    out = table(dealt.mapInArrow(run, f"{_ID}, start long, stop long, f_doc long, f_th long, shift long"), "passage-runs")
    drop(met)
    return out


def _looked_up(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted (doc_id, th, start, stop, node) once, with sh, the distinct shingle hashes of the span, if
    it has a node, and else its digest and hashes of up to WINDOW - 1 words before (nearest first) and behind."""
    w = wanted.distinct().groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "stop", "node")).alias("w"))
    types = {"doc_id": pa.int64(), "th": pa.int64(), "start": pa.int64(), "stop": pa.int64(), "node": pa.int64(), "sh": pa.list_(pa.int64()), "digest": pa.binary(), "before": pa.list_(pa.int64()), "behind": pa.list_(pa.int64())}

    def spans(doc_id: int, th: int, text: str, wanted: list[dict]) -> Iterator[tuple]:
        words = text.encode().split()
        h = word_hashes(words)
        g = grams(prefixes(h), SHINGLE)
        h = h.view(np.int64)
        for x in wanted:
            a, z = x["start"], x["stop"]
            if x["node"] is not None:
                yield doc_id, th, a, z, x["node"], np.unique(g[a : z - SHINGLE + 1]).view(np.int64), None, None, None
            else:
                yield doc_id, th, a, z, None, None, _digest(words[a:z]), h[max(0, a - WINDOW + 1) : a][::-1], h[z : z + WINDOW - 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], list(types))

        for b in batches:
            rows = []
            for i in range(b.num_rows):
                for row in spans(*(b.column(k)[i].as_py() for k in range(4))):
                    rows.append(row)
                    if len(rows) >= 4096:
                        yield out(rows)
                        rows = []
            if rows:
                yield out(rows)

    # of the texts, only those with a wanted span are shuffled, and rows alike in doc_id and text before that combined
    which = table(wanted.select("doc_id", "th").distinct(), "looked-in")
    d = within(_documents(docs), which, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"]).join(w, ["doc_id", "th"]).select("doc_id", "th", "text", "w")
    return d.mapInArrow(run, f"{_ID}, start long, stop long, node long, sh array<long>, digest binary, before array<long>, behind array<long>")


def _agree(x: str, y: str):
    """How many of the first elements of two arrays are equal."""
    at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
    return F.when(at > 0, at - 1).otherwise(F.size(x))


def _wordings(found: DataFrame) -> DataFrame:
    """h1, h2, f (first doc_id, th, start, stop, keys) and n of each distinct wording of a paragraph."""
    p = found.select("doc_id", "th", F.explode("paragraphs").alias("p"))
    first = F.min(F.struct("doc_id", "th", "p.start", "p.stop", "p.keys"))
    return table(p.groupBy("p.h1", "p.h2").agg(first.alias("f"), F.count("*").alias("n")).select("h1", "h2", "f.*", "n"), "wordings")


def removals(docs: DataFrame) -> DataFrame:
    """Spans to remove: doc_id, th, start, stop (word places), kind (passage or paragraph), kept_doc_id.

    Null texts are left alone. Documents without an id (null) come last, in the order of their texts'
    hashes. Rows that repeat a doc_id, or its absence, and its text are one document, which keeps what it is
    the first to hold. kept_doc_id is a document in which an earlier copy begins. Empty, blank and
    short texts have no spans, very long ones are worked on whole; an empty table gives none. Columns
    but doc_id and text are not read.
    """
    found = table(units(docs), "units")
    runs = _runs(found)
    wordings = _wordings(found)
    # the node of a wording is the first half of its digest
    met = bands.shared(wordings.select(F.col("h1").alias("node"), F.explode("keys").alias("key")), "paragraphs")
    alone = F.lit(None).cast("long").alias("node")
    nodes = table(met.select("node").distinct(), "paragraphs-nodes")
    wanted = within(wordings.withColumnRenamed("h1", "node"), nodes, "node").select("doc_id", "th", "start", "stop", "node")
    wanted = wanted.union(runs.select("doc_id", "th", "start", "stop", alone))
    wanted = wanted.union(runs.select("f_doc", "f_th", F.col("start") + F.col("shift"), F.col("stop") + F.col("shift"), alone))
    wanted = table(wanted, "wanted")
    seen = table(_looked_up(docs, wanted), "looked-up")

    own = seen.where("node is null").select("doc_id", "th", "start", "stop", "digest", "before", "behind")
    keeper = own.select(F.col("doc_id").alias("f_doc"), F.col("th").alias("f_th"), F.col("start").alias("f_start"), F.col("stop").alias("f_stop"), *(F.col(c).alias(f"f_{c}") for c in ("digest", "before", "behind")))
    both = runs.join(own, ["doc_id", "th", "start", "stop"]).withColumns({"f_start": F.col("start") + F.col("shift"), "f_stop": F.col("stop") + F.col("shift")})
    both = both.join(keeper, ["f_doc", "f_th", "f_start", "f_stop"]).where("digest = f_digest")
    start, stop = F.col("start") - _agree("before", "f_before"), F.col("stop") + _agree("behind", "f_behind")
    passages = both.select("doc_id", "th", start.alias("start"), stop.alias("stop"), F.lit("passage").alias("kind"), F.col("f_doc").alias("kept_doc_id"))

    comp = bands.linked(met, seen.where("node is not null").select("node", "sh"), "paragraphs", SIMILARITY)
    named = wordings.drop("keys").join(checked(comp.withColumnRenamed("node", "h1")), "h1", "left").where("n > 1 or component is not null")
    named = table(named.select("h1", "h2", F.coalesce("component", "h1").alias("component"), F.struct("doc_id", "th", "start").alias("f")), "paragraphs-named")
    first = named.groupBy("component").agg(F.min("f").alias("f"))
    keepers = table(named.drop("f").join(first, "component").select("h1", "h2", "f"), "paragraphs-kept")
    p = found.select("doc_id", "th", F.explode("paragraphs").alias("p")).select("doc_id", "th", "p.start", "p.stop", "p.h1", "p.h2")
    lines = p.join(checked(keepers), ["h1", "h2"]).where(F.struct("doc_id", "th", "start") != F.col("f"))
    lines = lines.select("doc_id", "th", "start", "stop", F.lit("paragraph").alias("kind"), F.col("f.doc_id").alias("kept_doc_id"))
    out = passages.unionByName(lines).distinct()
    out = table(out.withColumns({c: F.nullif(c, F.lit(NO_ID)) for c in ("doc_id", "kept_doc_id")}), "removals")
    drop(found, runs, wordings, met, nodes, wanted, seen, comp, named, keepers)
    return out


def clusters(found: DataFrame) -> DataFrame:
    """The rows of removals with cluster_id, the smallest doc_id of the documents that they connect. A document
    without an id is of its keeper's cluster, and of none if that has no id either."""
    edges = found.select(F.col("doc_id").alias("a"), F.col("kept_doc_id").alias("b")).where("a is not null and b is not null").distinct()
    comp = components(edges, "removal-clusters").select("node", F.col("component").alias("c"))
    d = found.withColumn("node", F.coalesce("doc_id", "kept_doc_id"))
    return d.join(comp, "node", "left").withColumn("cluster_id", F.coalesce("c", "node")).drop("c", "node")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """text without the given runs of words; what is left keeps its own spaces."""
    raw = text.encode()
    words = raw.split()
    gone = np.zeros(len(words), bool)
    for a, b in spans:
        gone[a:b] = True
    out, at, place = [], 0, 0
    for word, drop_ in zip(words, gone.tolist()):
        begin = raw.index(word, at)
        if not drop_:
            out.append(raw[place : begin + len(word)])
        place = at = begin + len(word)
    out.append(raw[place:])
    left = b"".join(out)
    return left.decode() if left.strip() else ""


def dedup(docs: DataFrame) -> DataFrame:
    """docs with repeated spans cut out of the text; n_chars, if there, counts anew.

    Documents of which nothing is left go; all others, also those without words from the start, stay
    with all their columns.
    """
    found = removals(docs)
    few = found.count() <= BROADCAST_ROWS
    found = found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    found = F.broadcast(found) if few else found  # the number of spans is checked, so that texts need no shuffle
    types, names = dict(docs.dtypes), docs.columns
    d = docs.select(F.struct(*names).alias("r"), F.col("doc_id").cast("long").alias("i"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    d = d.join(found, F.expr("i <=> doc_id and h = th"), "left").select("r.*", F.col("spans").alias("__spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, bands.SLICE):
                own = b.slice(k, bands.SLICE)
                texts, keep = own.column("text").to_pylist(), []
                for i, spans in enumerate(own.column("__spans").to_pylist()):
                    if spans:
                        texts[i] = without(texts[i], [(s["start"], s["stop"]) for s in spans])
                    keep.append(bool(texts[i] or not spans))
                new = {"text": pa.array(texts, pa.string())}
                if "n_chars" in names:
                    new["n_chars"] = pa.array([None if t is None else len(t) for t in texts], own.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays([new.get(c, own.column(c)) for c in names], names).filter(pa.array(keep))

    return d.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in names))
