"""The ten operators against brute force, and their defined results for odd inputs."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import bands, chat, common, language_id, mixing, packing, quality_model, quality_rules, queries, simhash, substring_dedup, warc, winnowing

R = random.Random(5)
VOCABULARY = ["".join(R.choice("abcdefghij") for _ in range(R.randint(2, 8))) for _ in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, r=R):
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def odd_documents():
    """Nulls, empty, blank, one huge word, a very long text, ties, repeated rows."""
    long_ = prose(6000)
    texts = [None, "", " \n\t ", "x" * 30000, long_, "one", "one", "Ähnlich – ça n'est\nпросто 漢字 \x1c z", "a b c d e f g h a b c d e f g h", "#$%& <b> | *"]
    out = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    return [*out, out[5], (None, "one", None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    d = spark.createDataFrame(odd_documents(), SCHEMA)
    return d.withColumns({c: F.lit(7) for c in ("th", "slice", "guest", "fp", "size", "score", "bucket", "row", "key")}).repartition(3).cache()


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def by_id(df, n=1):
    out = defaultdict(list)
    for r in df.collect():
        out[r[0]].append(tuple(r)[n:] if n else r)
    return out


# --- 1 packing -----------------------------------------------------------------------------------


def reference_ids(text):
    t = packing.word_tokenizer(packing.public_tokenizers.path(packing.TOKENIZER)).tokenizer
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")


def test_packing_covers_every_id_once(spark, odd):
    d = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    pieces = packing.pack(d, capacity=512).collect()
    got, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        got[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append(p)
    assert got.keys() == texts.keys()
    for i, own in got.items():
        ids = reference_ids(texts[i])
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for own in windows.values():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == list(np.cumsum([0, *(p["length"] for p in own)])[:-1])
        assert sum(p["length"] for p in own) <= 512


def test_packing_odd_rows(spark, odd):
    assert sum(r["start"] == 0 for r in packing.pack(odd).collect()) == odd.count()
    assert packing.pack(odd.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4096), min_size=1, max_size=80))
def test_windows_hold_all_and_fit(sizes):
    dealt = packing.windows(sizes)
    assert sorted(i for own in dealt for i in own) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in own) <= 4096 for own in dealt)


def test_differencing_is_near_equal():
    sizes = [R.randint(20, 1500) for _ in range(400)]
    loads = [sum(sizes[i] for i in own) for own in packing.karmarkar_karp(sizes, 60)]
    assert max(loads) - min(loads) <= 0.02 * max(loads)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=8))
def test_parts_give_the_tokenizers_ids(texts):
    t = packing.word_tokenizer(packing.public_tokenizers.path(packing.TOKENIZER))
    for text, ids in zip(texts, t.encode(texts)):
        assert np.array_equal(np.frombuffer(ids, "<u4"), reference_ids(text)[:-1])


# --- 2 winnowing ---------------------------------------------------------------------------------


def brute_winnow(hashes, w=winnowing.WINDOW):
    """(hash, place) of the rightmost smallest of every window."""
    out = []
    for i in range(max(1, len(hashes) - w + 1) if hashes else 0):
        own = hashes[i : i + w]
        out.append((min(own), i + max(k for k, h in enumerate(own) if h == min(own))))
    return list(dict.fromkeys(out))


def test_winnowing_against_brute_force(spark, odd):
    d = odd.select("doc_id", "text").withColumn("_w", common.word_array(common.text_of()))
    d = d.withColumn("g", winnowing.gram_hashes(F.col("_w"))).withColumn("p", winnowing.winnow(F.col("g")))
    of_gram = {}
    for r in d.collect():
        assert [tuple(x) for x in r["p"]] == brute_winnow(r["g"])
        w = words(r["text"])
        grams = [tuple(w[i : i + winnowing.K]) for i in range(len(w) - winnowing.K + 1)] or ([tuple(w)] if w else [])
        assert len(grams) == len(r["g"])
        for gram, h in zip(grams, r["g"]):
            assert of_gram.setdefault(gram, h) == h
    assert len(set(of_gram.values())) == len(of_gram)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 40])
def test_winnowing_takes_the_rightmost_tie(spark, size):
    g = [R.randint(0, 2) for _ in range(size)]
    got = spark.createDataFrame([(g,)], "g array<long>").select(winnowing.winnow(F.col("g")).alias("p")).first()["p"]
    assert [tuple(x) for x in got] == brute_winnow(g)


def test_winnowing_covers_every_window(spark):
    d = spark.createDataFrame([(1, "a b c d e a b c d e a b c d e")], "doc_id long, text string")
    got = winnowing.fingerprints(d).select(winnowing.places(F.col("prints")).alias("p")).first()["p"]
    n = 15 - winnowing.K + 1
    assert all(any(a <= p < a + winnowing.WINDOW for p in got) for a in range(n - winnowing.WINDOW + 1))
    assert len(set(got)) == len(got)


UNIT_PATTERN = re.compile(winnowing.UNITS.replace(r"\x{20000}-\x{3FFFF}", "\U00020000-\U0003ffff"))


def check_guarantee(texts, got):
    """Every text of which K + WINDOW - 1 whole units are left in the edited text shares a hash with it."""
    short = winnowing.K + winnowing.WINDOW - 1
    bound = 0
    for i, text in texts.items():
        left = text[: len(text) - len(text) // 3]
        whole = [m for m in UNIT_PATTERN.finditer(text) if m.end() <= len(left)]
        if len(whole) > short:  # the last one left may have grown into the text that follows
            assert got[i] > 0, text
            bound += 1
    return bound


def test_winnowing_guarantee(spark):
    """Scripts with and without spaces, mixed; 1 to 30 words; a word of 400 letters."""
    r = random.Random(8)
    han = lambda n: "".join(r.choice("的一是不了人我在有他这为之大来以个中上们𠀀") for _ in range(n))
    texts = [han(600), han(300), prose(300, r), han(40) + " " + prose(20, r) + han(9), "x" * 400, "สวัสดีชาวโลกทั้งหลายในวันนี้" * 3, *(prose(n, r) for n in range(1, 31)), *(han(n) for n in range(1, 31))]
    r.shuffle(texts)
    texts = dict(enumerate(texts))
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {x["doc_id"]: x for x in winnowing.edited_pairs(d).collect()}
    assert check_guarantee(texts, {i: x["near_edited"] for i, x in got.items()}) > 45
    assert winnowing.fingerprints(spark.createDataFrame([("",), (None,), (" \n",)], "text string")).where(F.size("prints") > 0).count() == 0


def test_winnowing_guarantee_on_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {x["doc_id"]: x["text"] or "" for x in d.collect()}
    got = {x["doc_id"]: x for x in queries.QUERIES["op2_winnowing"](spark, "/root/testdata/sf0.001").collect()}
    assert check_guarantee(texts, {i: x["near_edited"] for i, x in got.items()}) > 150
    assert np.median([x["near_edited"] for x in got.values()]) > 0.4 and np.median([x["near_next"] for x in got.values()]) < 0.05


@pytest.mark.parametrize("hot", [None, 7])
def test_edited_pairs_of_hot_ids(spark, hot):
    """All rows without an id, or half of all rows of one id, a third of them alike."""
    r = random.Random(3)
    rows = [(hot, prose(r.randint(1, 40), r)) for _ in range(60)] + [(hot, "the same text in all of these rows, ten words")] * 40
    rows += [(i if hot else None, prose(r.randint(1, 40), r)) for i in range(-40, 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    old, winnowing.SLICE_ROWS = winnowing.SLICE_ROWS, 6
    try:
        sliced, firsts, n = winnowing._sliced(d)
        assert n >= 20 and firsts.count() == n
        assert max(x["count"] for x in sliced.groupBy("slice").count().collect()) < 40
        got = winnowing.edited_pairs(d).collect()
    finally:
        winnowing.SLICE_ROWS = old
    th = {x["text"]: x["h"] for x in d.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, th[x[1]]), reverse=True)
    want = []
    for (i, own), (_, after) in zip(order, order[1:] + order[:1]):
        want.append((i, hashlib.sha256((own[: len(own) - len(own) // 3] + after[: len(own) // 3]).encode()).hexdigest()))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((x["doc_id"], x["edited_sha256"]) for x in got), key=key) == sorted(want, key=key)


def test_edited_pairs(spark):
    texts = {i: prose(R.randint(1, 300)) for i in range(40)} | {7: "", 8: "x", 9: None, 10: "ä" * 50}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    old, winnowing.SLICE_ROWS = winnowing.SLICE_ROWS, 6
    try:
        got = by_id(winnowing.edited_pairs(d))
    finally:
        winnowing.SLICE_ROWS = old
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        own, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        n = len(own)
        edited = own[: n - n // 3] + after[: n // 3]
        ((n_chars, sha, fp, efp, near_edited, near_next),) = got[i]
        assert (n_chars, sha) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= near_next <= 1 and 0 <= near_edited <= 1
        if n < 3:
            assert near_edited == 1 and fp == efp
    long_ = [i for i in order if len(texts[i] or "") > 800]
    assert np.mean([got[i][0][4] for i in long_]) > 0.3 > np.mean([got[i][0][5] for i in long_])


def test_edited_pairs_odd(spark, odd):
    got = winnowing.edited_pairs(odd).collect()
    assert len(got) == odd.count()
    same = {r["fingerprint"] for r in got if r["n_chars"] == 3}
    assert len(same) == 1
    assert winnowing.edited_pairs(odd.limit(0)).count() == 0
    one = winnowing.edited_pairs(odd.where("doc_id = 4")).first()
    assert one["near_next"] == 1


# --- 3 substring dedup ---------------------------------------------------------------------------


def test_passages_are_found_wherever_they_stand(spark):
    passage = prose(55)
    texts = {i: prose(R.randint(60, 200)) for i in range(30)}
    for i in (3, 11, 20, 21):
        w = texts[i].split()
        k = R.randint(5, len(w) - 5)
        texts[i] = " ".join(w[:k]) + " " + (passage if i != 20 else passage.replace(" ", "\n", 9)) + " " + " ".join(w[k:])
    texts[25] = "A heading of nine words that many documents share.\n" + texts[25]
    texts[26] = "A heading of nine words that many documents share.\n" + texts[26]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA)
    found = substring_dedup.removals(d)
    assert {(r["doc_id"], r["kept_doc_id"]) for r in found.collect()} == {(11, 3), (20, 3), (21, 3)}
    assert {r["cluster_id"] for r in substring_dedup.clusters(found).collect()} == {3}
    left = {r["doc_id"]: r for r in substring_dedup.dedup(d).collect()}
    assert left.keys() == texts.keys()
    for i, t in texts.items():
        assert (left[i]["text"] == t) == (i not in (11, 20, 21))
        assert left[i]["n_chars"] == len(left[i]["text"])
        if i in (11, 20, 21):  # the whole passage is gone, and but for chance agreement at its ends nothing else
            assert len(t.split()) - 57 <= len(left[i]["text"].split()) <= len(t.split()) - 55


def test_inner_anchors_change_no_run(spark, monkeypatch):
    """With the anchors that always stand together met by their ends only, fewer meet and the same spans go."""
    r = random.Random(5)
    long, short = prose(400, r).split(), prose(60, r).split()
    texts = [[*prose(r.randint(0, 30), r).split(), *long[: r.choice((400, 250))], *short, *prose(9, r).split()] for _ in range(25)]
    texts += [[*short, *prose(20, r).split(), *long], [*long, *short, *long], prose(12, r).split(), long[:24]]
    texts[7][140] = texts[9][200] = "changed"
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    ends, met = substring_dedup._ends, []
    key = lambda df: sorted(map(tuple, df.collect()), key=str)

    def counted(twice):
        met.append((ends(twice).count(), twice.select("key").distinct().count()))
        return ends(twice)

    monkeypatch.setattr(substring_dedup, "_ends", counted)
    got = key(substring_dedup.removals(d))
    assert met[0][0] < 0.8 * met[0][1]
    monkeypatch.setattr(substring_dedup, "_ends", lambda twice: twice.groupBy("key").agg(F.min(F.struct("doc_id", "th", "at", "ahead")).alias("f")))
    assert got == key(substring_dedup.removals(d))


def word_grams(w, n=5):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_paragraphs_alike_by_exact_jaccard(spark):
    base = prose(120).split()
    near, far = base.copy(), base.copy()
    near[60] = "changed"
    for k in range(0, 120, 7):
        far[k] = f"other{k}"
    other = {i: prose(80) for i in range(3, 8)}
    texts = {0: " ".join(base), 1: " ".join(near), 2: " ".join(far)} | other
    d = spark.createDataFrame([(i, f"{prose(10)}\n{t}", "en", "s", 0) for i, t in texts.items()], SCHEMA)
    got = substring_dedup.removals(d).where("kind = 'paragraph'").collect()
    assert [(r["doc_id"], r["start"], r["stop"], r["kept_doc_id"]) for r in got] == [(1, 10, 130, 0)]
    assert jaccard(word_grams(base), word_grams(near)) >= 0.8 > jaccard(word_grams(base), word_grams(far))


def test_short_lines_are_put_together():
    p = substring_dedup.paragraphs
    assert p([12, 12, 3]) == [(0, 27)] and p([30, 12, 12, 12, 40]) == [(0, 30), (30, 66), (66, 106)]
    assert p([5, 0, 30]) == [(5, 35)] and p([8, 30, 19]) == [(8, 38)] and p([12, 0, 12]) == [] and p([]) == []
    assert p([20, 20, 0, 10, 10, 9, 9, 9]) == [(0, 20), (20, 40), (40, 60), (60, 87)]


def test_anchor_guarantee():
    r = np.random.default_rng(1)
    for _ in range(50):
        a, b, s = (r.integers(0, 1 << 62, n).astype(np.uint64) for n in (70, 90, 50))
        x, y = (bands.grams(bands.prefixes(np.concatenate(v)), substring_dedup.GRAM) for v in ([a[:33], s, a[33:]], [b[:71], s, b[71:]]))
        p, q = substring_dedup.anchors(x), substring_dedup.anchors(y)
        assert {int(i) - 33 for i in p if 33 <= i <= 33 + 25} & {int(i) - 71 for i in q if 71 <= i <= 71 + 25}


def test_anchors_against_brute_force():
    r = np.random.default_rng(2)
    for n in (0, 1, 5, 25, 26, 27, 200, 999):
        for high in (4, 1 << 20):  # few values: many ties
            g = r.integers(0, high, n).astype(np.uint64) << np.uint64(24)
            w = min(n, substring_dedup.WINDOW)
            want = {max(i for i in range(j, j + w) if g[i] == g[j : j + w].min()) for j in range(n - w + 1)} if n else set()
            assert substring_dedup.anchors(g).tolist() == sorted(want)


def brute_covered(docs):
    """{id: places of words in a run of 50 or more that stands in an earlier place}, by comparing all runs."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        w = t.split()
        new = [tuple(w[k : k + 50]) for k in range(len(w) - 49)]
        out[i] = set()
        for k, run in enumerate(new):
            if run in seen:
                out[i] |= set(range(k, k + 50))
            seen.add(run)
    return out


def test_passages_against_brute_force(spark):
    """Every run of 50 words that an earlier document has is gone, but for a few words at its ends, also with third documents that hold
    parts of it, and nothing else but what has 25 words in common goes."""
    r = random.Random(12)
    phrases = [prose(12, r) for _ in range(6)]
    docs = [(i, " ".join([prose(15, r), r.choice(phrases), prose(40, r), r.choice(phrases)])) for i in range(40)]
    for i in range(40, 140):
        a = r.choice(docs)[1].split()
        k = r.randint(0, max(0, len(a) - 55))
        docs.append((i, " ".join([prose(r.randint(5, 60), r), *a[k : k + r.randint(50, 79)], r.choice(phrases), prose(r.randint(0, 60), r)])))
    got = defaultdict(set)
    for x in substring_dedup.removals(spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string").repartition(4)).collect():
        got[x["doc_id"]] |= set(range(x["start"], x["stop"]))
    want = brute_covered(docs)
    missed = sum(len(want[i] - got[i]) for i in want)
    assert missed <= 0.02 * sum(map(len, want.values())) and all(got[i] & want[i] for i in want if want[i])
    seen = set()
    for i, t in docs:
        w = t.split()
        twice = set()
        for k in range(len(w) - 24):
            if tuple(w[k : k + 25]) in seen:
                twice |= set(range(k, k + 25))
        seen |= word_grams(w, 25)
        assert len(got[i] - twice) <= 0


def test_links_of_paragraphs_with_boilerplate(spark):
    """All pairs by brute force: 300 pairs alike that share 70 of 100 words with all the others."""
    r = random.Random(14)
    frame, docs = prose(70, r), []
    for i in range(300):
        w = (frame + " " + prose(30, r)).split()
        docs.append((2 * i, " ".join(w)))
        w[85] = "edited"
        docs.append((2 * i + 1, " ".join(w)))
    sets = {i: word_grams(t.split()) for i, t in docs}
    pairs = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    assert len(pairs) >= 300
    want = {max(b, a) for a, b in pairs}
    got = {x["doc_id"] for x in substring_dedup.removals(spark.createDataFrame(docs, "doc_id long, text string")).where("kind = 'paragraph'").collect()}
    assert len(want - got) <= 3 and not got - want


def test_substring_dedup_odd(spark, odd):
    out = substring_dedup.dedup(odd)
    assert out.columns == odd.columns
    assert out.where("doc_id is null").count() == 2
    assert substring_dedup.dedup(odd.limit(0)).count() == 0
    assert substring_dedup.removals(odd.where("text is null")).count() == 0


def test_whole_copies_go(spark):
    t = prose(100)
    d = spark.createDataFrame([(1, t, "en", "s", 0), (2, t, "en", "s", 0), (3, "", "en", "s", 0)], SCHEMA)
    left = {r["doc_id"]: r["text"] for r in substring_dedup.dedup(d).collect()}
    assert left == {1: t, 3: ""}


def test_substring_dedup_repeated_rows_and_very_long_texts(spark):
    t, long_ = prose(100), prose(60000)
    d = spark.createDataFrame([(1, t)] * 20 + [(2, long_), (3, prose(30) + "\n" + long_ + "\n" + prose(30)), (4, "a " * 5000)], "doc_id long, text string")
    left = by_id(substring_dedup.dedup(d))
    assert left[1] == [(t,)] * 20 and left[2] == [(long_,)]
    assert 58 <= len(left[3][0][0].split()) <= 60 and len(left[4][0][0].split()) < 60


def test_substring_dedup_without_ids(spark):
    """Rows without an id lose what earlier documents hold, and of what only they hold one copy stays."""
    r = random.Random(21)
    shared, tail, own = prose(90, r), prose(40, r), prose(70, r)
    rows = [(None, shared), (None, shared), (1, f"{shared} {tail}"), (2, shared), (None, own), (None, f"{tail[:50]} {own}"), (None, None)]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(3)
    got = sorted((x["doc_id"] or 0, x["text"] or "") for x in substring_dedup.dedup(d).collect())
    texts = [t for _, t in got]
    assert (1, f"{shared} {tail}") in got and sum(shared in t for t in texts) == 1 and sum(own in t for t in texts) == 1 and not any(i == 2 for i, _ in got)
    spans = substring_dedup.clusters(substring_dedup.removals(d)).collect()
    assert {x["cluster_id"] for x in spans if x["kept_doc_id"] == 1} == {1} and {x["doc_id"] for x in spans} == {None, 2}


# --- 4 simhash -----------------------------------------------------------------------------------


def brute_simhash(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, radius=2):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(len(fps)):
        least[root(i)].append(ids[i])
    return {ids[i]: min(least[root(i)]) for i in range(len(fps))}


def test_simhash_against_brute_force(spark):
    base = [prose(R.randint(0, 120)) for _ in range(25)]
    texts = []
    for t in base:
        texts.append(t)
        for _ in range(R.randint(0, 5)):
            w = t.split()
            if w:
                w[R.randrange(len(w))] = R.choice(VOCABULARY)
            texts.append(" ".join(w))
    texts += ["", None, "  ", "one", "One", "one two"]
    d = spark.createDataFrame([(100 - i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in simhash.simhash_groups(d).collect()}
    fps = [brute_simhash(t) for t in texts]
    ids = [100 - i for i in range(len(texts))]
    assert {i: got[i]["fp"] & (1 << 64) - 1 for i in ids} == dict(zip(ids, fps))
    assert {i: got[i]["component_id"] for i in ids} == brute_components(fps, ids)


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 1 << 30))
def test_tree_links_are_whole(seed):
    r = random.Random(seed)
    keys = {0}
    centre = r.getrandbits(64)
    while len(keys) < 150:
        keys.add(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
    keys = sorted(keys)
    for limit in (simhash.TREE_ROWS, 8):
        old, simhash.TREE_ROWS = simhash.TREE_ROWS, limit
        try:
            found = simhash.shard_links(keys, (1 << 64) - 1)
        finally:
            simhash.TREE_ROWS = old
        parent = {k: k for k in keys}

        def root(k, parent=parent):
            while parent[k] != k:
                k = parent[k]
            return k

        for a, b in found:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        groups = defaultdict(set)
        for k in keys:
            groups[root(k)].add(k)
        want = brute_components(keys, keys)
        assert all(len({want[k] for k in g}) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_simhash_odd(spark, odd):
    got = simhash.simhash_groups(odd).collect()
    assert len(got) == odd.count()
    assert {r["component_id"] for r in got if r["fp"] == 0} == {0}
    assert simhash.simhash_groups(odd.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7), (5000, 5001), (5001, 5000)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(80)} == {1000} and got[5001] == 5000
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 5 quality rules -----------------------------------------------------------------------------


def brute_rules(text):
    t = text or ""
    w = words(t)
    grams = defaultdict(list)
    for i in range(len(w) - 7):
        grams[tuple(w[i : i + 8])].append(i)
    covered = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_quality_rules_against_brute_force(spark, odd):
    extra = [(100 + i, "\n".join(R.choice([prose(9), "same line of some eight words or so here", "* x *"]) for _ in range(R.randint(1, 12))), "en", "s", 0) for i in range(30)]
    d = odd.select("doc_id", "text").where("doc_id is not null").dropDuplicates().union(spark.createDataFrame(extra, SCHEMA).select("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    for r in quality_rules.apply_policy(quality_rules.ledger(d, "doc_id")).collect():
        want = brute_rules(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_ablation_and_empty(spark, odd):
    m = quality_rules.ledger(odd, "doc_id").cache()
    rows = m.collect()
    mask = quality_rules.STANDARD.mask
    for r in quality_rules.ablation(m).collect():
        bit = 1 << quality_rules.RULES.index(r["rule"])
        assert r["failed"] == sum(bool(x["fail_bits"] & bit) for x in rows)
        assert r["alone"] == sum(x["fail_bits"] & mask == bit for x in rows)
    assert quality_rules.ledger(odd.limit(0)).count() == 0


# --- 6 quality classifier, 9 language ------------------------------------------------------------


def labelled(spark, n=400):
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        t = prose(R.randint(30, 120))
        if not good:
            t = t.upper().replace(" ", " ### ")
        docs.append((i, t, "en", "s", len(t)))
        if i % 10:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_model_on_held_out(spark, odd):
    docs, labels = labelled(spark)
    model = quality_model.fit(docs, labels.where(quality_model.crc_mod(3) != 1))
    got = quality_model.score(docs, model, "doc_id").join(labels, "doc_id").where(quality_model.crc_mod(3) == 1).collect()
    assert len(got) > 80 and np.mean([(r["score"] >= 0.5) == r["quality"] for r in got]) > 0.97
    out = quality_model.score(odd, model, "doc_id").collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert quality_model.score(odd.limit(0), model, "doc_id").count() == 0
    nothing = quality_model.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality_model.score(docs, nothing, "doc_id").collect()} == {0.5}
    assert quality_model.crc_mod(3) is not None and spark.range(5).select(quality_model.crc_mod(3, "id").alias("m")).collect()[3]["m"] == zlib.crc32(b"3") % 3


def test_tree_traversal_equals_walking():
    r = np.random.default_rng(2)
    x = r.normal(size=(600, len(quality_model.STATISTICS)))
    y = (x[:, 0] + x[:, 3] * x[:, 5] > 0).astype(float)
    m = quality_model.train(x, y)
    b = m.binned(x)
    for i in range(0, 600, 37):
        total = m.base
        for f, c, v in zip(m.feature, m.cut, m.value):
            k = 0
            for _ in range(quality_model.DEPTH):
                k = 2 * k + 1 + int(b[i, f[k]] > c[k])
            total += v[k - len(f)]
        assert m.score(x[i : i + 1])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert np.mean((m.score(x) > 0.5) == y) > 0.9


def test_language_on_held_out(spark, odd):
    r = random.Random(9)
    alphabets = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ßäöüijkl"}
    docs = [(i, " ".join("".join(r.choice(alphabets[k]) for _ in range(6)) for _ in range(40)), k, "s", 0) for i in range(300) for k in [sorted(alphabets)[i % 3]]]
    docs.append((300, "efgh ijkl", None, "s", 0))
    d = spark.createDataFrame(docs, SCHEMA)
    model = language_id.fit(d.where(quality_model.crc_mod(4) != 2))
    got = language_id.predict(d.where("lang is not null"), model, "doc_id", "lang").where(quality_model.crc_mod(4) == 2).collect()
    assert len(got) > 50 and np.mean([x["lang"] == x["lang_pred"] for x in got]) > 0.98
    out = {x["doc_id"]: x for x in language_id.predict(odd.where("doc_id is not null"), model, "doc_id").collect()}
    assert {out[i]["lang_pred"] for i in (0, 1, 2, 9)} == {"und"} or out[9]["lang_pred"] in alphabets
    assert out[0]["lang_pred"] == out[1]["lang_pred"] == "und" and all(0 <= x["score"] <= 1 for x in out.values())
    assert language_id.predict(odd.limit(0), model, "doc_id").count() == 0
    assert language_id.fit(d.limit(0)).langs == ["und"]
    signs = spark.createDataFrame([(0, "\u00bd \u00b2 \u2460 12 _"), (1, "12 \u02b0")], "doc_id long, text string")
    got = {x["doc_id"]: x["lang_pred"] for x in language_id.predict(signs, model, "doc_id").collect()}
    assert got[0] == "und" and got[1] != "und"


def dense_ridge(rows, test):
    """The same regression with all presence vectors in one matrix, and its scores of the test texts."""
    norm = lambda x: x / np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True)))
    langs = sorted({r["lang"] for r in rows})
    rows = sorted(rows, key=lambda r: (r["unit"], bytes(r["bits"])))
    x = norm(np.array([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in rows], float))
    per = max(1, language_id.LANDMARKS // len(langs))
    z = x[[i for lang in langs for i in [k for k, r in enumerate(rows) if r["lang"] == lang][:per]]]
    value, vector = np.linalg.eigh(z @ z.T)
    good = value > 1e-6 * value.max()
    phi = x @ z.T @ (vector[:, good] / np.sqrt(value[good]))
    size = {lang: sum(r["n"] for r in rows if r["lang"] == lang) for lang in langs}
    weight = np.array([r["n"] / size[r["lang"]] for r in rows])[:, None]
    y = np.array([[1.0 if r["lang"] == lang else -1.0 for lang in langs] for r in rows])
    w = np.linalg.solve(phi.T @ (weight * phi) + language_id.RIDGE * np.eye(phi.shape[1]) / len(langs), phi.T @ (weight * y))
    t = norm(np.array([language_id.presence(x) for x in test], float))
    return langs, t @ z.T @ (vector[:, good] / np.sqrt(value[good])) @ w


def test_language_fit_is_the_dense_regression(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    d = d.unionByName(d.limit(9)).withColumn("doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("doc_id")))  # repeated rows, missing ids
    rows = language_id.sample(d, 60).collect()
    texts = [r["text"] for r in d.where("text is not null").limit(80).collect()]
    langs, scores = dense_ridge(rows, texts)
    model = language_id.fit(d, 60)
    got, _ = model.predict(texts)
    assert model.langs == langs and got == [langs[k] for k in scores.argmax(axis=1)]
    assert 100 < sum(r["n"] for r in rows) and any(r["n"] > 1 for r in rows)


def test_very_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 600)
    r = random.Random(10)
    docs = [(i, " ".join(chr(0x4E00 + 10 * (i % 300) + r.randrange(10)) for _ in range(30)), f"l{i % 300}", "s", 0) for i in range(900)]
    d = spark.createDataFrame(docs, SCHEMA)
    folded = language_id.fit(d)
    monkeypatch.setattr(language_id, "MOST_LANDMARKS", 200)  # fewer than languages: the model keeps landmarks
    model = language_id.fit(d)
    assert len(folded.langs) > 200 and folded.second is None and model.second.shape[0] == 200
    texts = [x[1] for x in docs[:60]]
    for m in (folded, model):
        known = [(t, x[2]) for t, x in zip(texts, docs) if x[2] in m.langs]
        assert np.mean([a == b for a, (_, b) in zip(m.predict([t for t, _ in known])[0], known)]) > 0.6


def test_presence_kernel_equals_sets():
    a, b = "Der Hund läuft", "der hut lacht"
    grams = lambda t: {(n, t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    x, y = language_id.presence(a), language_id.presence(b)
    assert abs(int((x & y).sum()) - len(grams(a.lower()) & grams(b.lower()))) <= 1
    assert abs(int(x.sum()) - len(grams(a.lower()))) <= 1
    assert language_id.presence("").sum() == 0 and language_id.presence("a").sum() == 1


# --- 7 WARC --------------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    pages = [(i, f"http://x/{i}\r\ny", R.choice(["<p>a</p>", "", None, "ö" * i])) for i in range(60)]
    pages += [pages[3], (None, None, "alone"), (None, "u", "<p>a</p>")]
    d = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha1", F.lit("x")).withColumn("last", F.lit(1)).repartition(3)
    index = warc.write_archives(d, f"file://{tmp_path}/w")
    assert index.count() == len(pages)
    got = warc.read_records(index, payloads=True).collect()
    last = {}
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(last.get(h or "", -1), i)
    assert len(got) == len(pages)
    for r in got:
        if r["record_type"] == "response":
            assert base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() == r["payload_digest"]
            assert len(r["payload"]) == r["payload_bytes"] and r["refers_to"] is None
    want = defaultdict(list)
    for i, _, h in pages:
        raw = (h or "").encode()
        other = last.get(h or "")
        revisit = other is not None and i != other
        want[i].append((len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", other if revisit else None))
    have = defaultdict(list)
    for r in got:
        have[r["page_id"]].append((r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]))
    assert {k: sorted(v, key=str) for k, v in have.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    some = warc.read_records(index.where("page_id in (5, 17)")).collect()
    assert {r["page_id"] for r in some} == {5, 17}
    assert warc.read_records(warc.write_archives(d.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_ranges_join_near_records():
    places = [("a", 0, 10), ("a", 10, 5), ("a", 10 + warc.GAP_BYTES + 100, 7), ("b", 0, 3)]
    assert [x[3] for x in warc.ranges(places)] == [[0, 1], [2], [3]]


# --- 8 chat --------------------------------------------------------------------------------------

control = st.sampled_from([*chat.CONTROLS, "\\", "[", "]", "<", "/s>", " ", "INST]", "a", "ö", "\n"])
body = st.lists(control, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "] odd ]", "ROLE="]), body), max_size=6))
def test_grammar_round_trip(turns):
    text = "".join(chat.render(r, t) for r, t in turns)
    got = chat.parse(text)
    assert [x[:2] for x in got] == turns
    assert all(chat.unescape(text[a:b]) == t for _, t, a, b in got)


def test_chat_digests(spark):
    rows = [(c, t, R.choice(["user", "assistant", "system", None]), R.choice([None, "", "</s>", "hi [INST]", prose(9)])) for c in [*range(9), None] for t in range(R.randint(1, 6))]
    rows += [rows[0], (3, None, "user", "x")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))
    old, chat.SEGMENT = chat.SEGMENT, 40
    try:
        got = by_id(chat.round_trip(d))
    finally:
        chat.SEGMENT = old
    want = defaultdict(list)
    for c, t, r, x in rows:
        want[c].append(((t is not None, t or 0), r or "", x or ""))
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        ((n, sha, chars, loss_sha, total),) = got[c]
        assert n == len(turns) and sha == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (chars, loss_sha) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert total == len("".join(chat.render(r, x) for _, r, x in turns))
    assert chat.round_trip(d.limit(0)).count() == 0


def test_a_conversation_is_rendered_by_many_tasks(spark):
    rows = [(None, i // 2, ("assistant", "user")[i % 2], f"</s> {i}") for i in range(3000)] + [(1, 0, "user", "x" * 300_000)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        formatted = common.table(chat.format_conversations(d), "chat")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert formatted.where("conv_id is null").select("part").distinct().count() > 1
    got = by_id(chat.read_back(formatted))
    ((n, sha, chars, _, _),) = got[None]
    turns = sorted((t, r, x) for c, t, r, x in rows if c is None)
    assert n == 3000 and sha == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
    assert chars == sum(len(x) for _, r, x in turns if r == "assistant") and got[1][0][4] == 300_000 + 15


# --- 10 mixing -----------------------------------------------------------------------------------


def test_targets_are_filled_like_water():
    assert mixing.targets([100, 100, 100], [3, 1, 2], 450) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.targets([10, 1000], [3, 1], 1515) == pytest.approx([20, 1495])
    assert mixing.targets([], [], 0) == []


def test_route_repeats_the_least():
    flow = mixing.route([((0,), 100), ((0, 1), 50), ((1,), 10)], [120, 60])
    assert sum(v for (p, s), v in flow.items() if s == 0) == 120 and sum(v for (p, s), v in flow.items() if s == 1) == 60
    used = [sum(v for (p, _), v in flow.items() if p == k) for k in range(3)]
    assert used[0] <= 200 and sum(max(0, u - n) for u, n in zip(used, (100, 50, 10))) == 20


def test_mix_meets_targets(spark, odd):
    r = random.Random(3)
    docs = [(i, prose(r.randint(0, 60)), "en", r.choice(["b", "a", "a", "a", None, "ä"]), 0) for i in range(300)]
    d = spark.createDataFrame(docs, SCHEMA).withColumn("target", F.lit(1)).withColumn("pattern", F.lit(2))
    sizes = mixing.sized(d).select("doc_id", "size", mixing.single_source().alias("sources"))
    rows = mixing.mix(sizes).collect()
    assert rows == sorted(rows, key=lambda r: 0) and sorted(map(str, rows)) == sorted(map(str, mixing.mix(sizes.repartition(5)).collect()))
    by = defaultdict(list)
    for x in rows:
        by[x["sources"][0]].append(x)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    goal = mixing.targets([by[s][0]["source_size"] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(x["size"] for x in rows))
    for s, g in zip(names, goal):
        assert by[s][0]["source_size"] == sum(x["size"] for x in by[s]) and by[s][0]["target"] == pytest.approx(g)
        assert abs(sum(x["taken"] for x in by[s]) - g) <= 1
        assert all(0 <= x["taken"] <= 2 * x["size"] for x in by[s])
    out = mixing.mix(mixing.sized(odd).select("doc_id", "size", mixing.single_source().alias("sources")))
    assert out.count() == odd.count()
    assert mixing.mix(sizes.limit(0)).count() == 0


def test_mix_of_rows_alike_and_without_ids(spark, monkeypatch):
    rows = [(None, 7, ["a"])] * 50 + [(None, 3, ["a"])] * 10 + [(i, 5, ["b"]) for i in range(40)] + [(1, 5, ["b"])] * 9
    d = spark.createDataFrame(rows, "doc_id long, size long, sources array<string>").withColumn("text_hash", F.col("size"))
    got = []
    for n, copies in ((50_000, 1 << 20), (2, 4)):
        monkeypatch.setattr(mixing, "BUCKET_ROWS", n)
        monkeypatch.setattr(mixing, "COPIES", copies)
        got.append(sorted(map(str, mixing.mix(d.repartition(3), carry=("text_hash",)).collect())))
    assert got[0] == got[1] and len(got[0]) == len(rows)
    out = mixing.mix(d, carry=("text_hash",)).collect()
    assert abs(sum(x["taken"] for x in out) - 1.5 * sum(r[1] for r in rows)) <= 1 and all(x["taken"] <= 2 * x["size"] for x in out)
    assert sum(0 < x["taken"] % x["size"] for x in out) <= 2


def test_route_falls_apart_into_what_hangs_together():
    r = random.Random(2)
    patterns = [([2 * k], r.randint(1, 50)) for k in range(20)] + [([2 * k, 2 * k + 1], r.randint(1, 50)) for k in range(20)]
    quotas = [r.randint(0, 60) for _ in range(40)]
    parts = mixing.joined(patterns, 40)
    assert sorted(map(len, (p for p, _ in parts))) == [2] * 20
    whole, own = mixing._flow(patterns, quotas, 2), mixing.route(patterns, quotas)
    cost = lambda f: sum(max(0, sum(f.get((p, s), 0) for s in own) - size) for p, (own, size) in enumerate(patterns))
    assert sum(whole.values()) == sum(own.values()) and cost(whole) == cost(own)


def test_mix_of_overlapping_sources(spark):
    d = spark.createDataFrame([(i, ["a"] if i % 3 else ["a", "b"], 10) for i in range(60)], "doc_id long, sources array<string>, size long")
    rows = mixing.mix(d, weights=(1, 1), share=1.0).collect()
    assert sum(r["taken"] for r in rows) == 600 and all(r["taken"] <= 20 for r in rows)
