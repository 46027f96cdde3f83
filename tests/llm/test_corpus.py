"""Dedup, near duplicates, scores, neighbours, chats, languages and the pipeline by brute force."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from airwave.llm import chat, exact, jaccard, katz, language, neighbours, queries, shingles
from airwave.llm.shingles import shingle_sets
from tests.llm.conftest import ODD

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(LOWER))


# Exact duplicates


def test_exact_duplicates_of_odd_rows(spark, documents, odd):
    got = exact.exact_duplicates(odd, block=16).collect()
    assert len(got) == len(ODD)
    groups = defaultdict(list)
    for i, t in ODD:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    shas = {sha256(t.encode()).hexdigest(): t for t in groups}
    for row in got:
        ids = groups[shas[row.text_sha256]]
        known = [i for i in ids if i is not None]
        assert row.group_size == len(ids)
        assert row.keep_id == (min(known) if known else None)
    assert sum(r.kept for r in got) == len(groups)
    kept = exact.drop_exact_duplicates(odd, block=16)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    clashing = odd.withColumnsRenamed({"ids": "row_key", "label": "nth"})
    kept = exact.drop_exact_duplicates(clashing, block=16)
    assert kept.columns == clashing.columns and kept.count() == len(groups)
    assert {r.row_key for r in kept.collect()} == {"x"}


def test_blocks_are_named_without_collision(documents):
    base = "abcdefghij" * 30
    rows = [(i, base) for i in range(40)]
    # One differing character anywhere, other lengths, shifted blocks.
    rows += [(100 + i, base[:i] + "X" + base[i + 1 :]) for i in range(0, 300, 23)] * 2
    rows += [(900 + n, base[:n]) for n in (8, 16, 17, 32, 64, 299)] * 2
    got = exact.exact_duplicates(documents(*rows), block=8).collect()
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t, i)
    sizes = Counter(t for _, t in rows)
    text = dict(rows)
    assert len(got) == len(rows)
    for row in got:
        assert row.keep_id == first[text[row.doc_id]]
        assert row.group_size == sizes[text[row.doc_id]]
    assert sum(r.kept for r in got) == len(sizes)


def test_exact_duplicates_of_an_empty_table(empty):
    assert exact.exact_duplicates(empty).count() == 0


# N-gram Jaccard join


def brute_components(rows, words=5, percent=80):
    sets = []
    for _, t in rows:
        w = split(t)
        n = len(w)
        grams = {tuple(w[k : k + words]) for k in range(n - words + 1)} if n >= words else set()
        sets.append(grams or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return [
        (i, len(sets[k]), min(least[find(k)]) if least[find(k)] else None)
        for k, (i, _) in enumerate(rows)
    ]


def test_jaccard_components(documents):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(vocabulary, 60))
    rows = [(i, " ".join(rng.choice(vocabulary, 150)) + " " + passage) for i in range(30)]
    rows += [(50 + i, passage) for i in range(3)]
    for base in range(3):
        w = rows[base][1].split()
        # Copies of copies drift away from their origin step by step.
        for step in range(12):
            at = int(rng.integers(0, len(w)))
            w[at] = "new%d" % step
            rows.append((100 + 20 * base + step, " ".join(w)))
        for near in range(8):
            v = rows[base][1].split()
            for at in rng.integers(0, len(v), 5):
                v[at] = f"changed{near}"
            rows.append((300 + 20 * base + near, " ".join(v)))
    rows += ODD
    got = jaccard.jaccard_components(documents(*rows, extra=["class", "n", "label", "prefix"]))
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == sorted(brute_components(rows), key=repr)


def test_near_duplicates_go(documents):
    text = " ".join(f"w{i}" for i in range(200))
    docs = documents((1, text), (2, text + " more"), (3, "other words"), (None, "x"), (None, "x"))
    got = jaccard.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=repr) == [1, 3, None, None]


def test_each_text_of_a_doc_id_is_judged_on_its_own(documents):
    text = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"v{i}" for i in range(200))
    docs = documents(
        (1, text), (2, text + " more"), (2, "a clean text that is like no other one here"),
        (None, other), (None, other + " end"), (None, "alone among the rows without id"),
        extra=["id", "text_key", "class", "label", "kept", "dropped", "given"],
    )
    got = jaccard.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    kept = sorted((str(r.doc_id), r.text[:7]) for r in got.collect())
    assert [i for i, _ in kept] == ["1", "2", "None", "None"]
    assert ("2", "a clean") in kept and ("None", "alone a") in kept


def test_near_copies_that_are_no_links_make_few_pairs(documents, monkeypatch):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = rng.choice(vocabulary, 150).tolist()
    passage = rng.choice(vocabulary, 60).tolist()
    rows = []
    for i in range(400):
        # Copies with four changed words are like the text, but not like each other.
        w = list(base)
        for at in rng.choice(len(w), 4, replace=False):
            w[at] = f"c{i}x{at}"
        rows.append((i, " ".join(w)))
    for i in range(300):
        rows.append((1000 + i, " ".join([*passage, *(f"p{i}x{j}" for j in range(int(rng.integers(1, 30))))])))
    made = []
    real = jaccard.similar

    def noted(pairs, *more):
        made.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(jaccard, "similar", noted)
    got = sorted(map(tuple, jaccard.jaccard_components(documents(*rows)).collect()))
    assert got == sorted(brute_components(rows))
    assert sum(made) < 4 * len(rows)


def test_jaccard_of_an_empty_table(empty):
    assert jaccard.jaccard_components(empty).count() == 0


def test_shingles_do_not_depend_on_the_stretch(monkeypatch):
    texts = [t or "" for _, t in ODD] + [f"Word{i % 7} and\tmore" for i in range(30)]
    want = shingle_sets(texts)
    monkeypatch.setattr("airwave.llm.shingles.STRETCH", 16)
    for a, b in zip(shingle_sets(texts), want):
        assert a.tolist() == b.tolist()


# Katz scores


def brute_katz(rows, order=3):
    texts = [(i, split(t) + [None]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    words, grams = Counter(), [defaultdict(Counter) for _ in range(order + 1)]

    def histories(w, p):
        before = (0, *w[:p])
        return [before[-n:] for n in range(1, min(order - 1, len(before)) + 1)]

    for (_, w), out in zip(texts, held):
        if not out:
            words.update(w)
            for p, x in enumerate(w):
                for h in histories(w, p):
                    grams[len(h)][h][x] += 1
    total, types = sum(words.values()), len(words)

    def classes(counts):
        n = Counter(counts)
        return katz.discounts([n[r] for r in range(1, katz.DISCOUNTED + 2)])

    d1 = classes(words.values())
    d = [classes(c for m in table.values() for c in m.values()) for table in grams]
    top = katz.DISCOUNTED + 1
    unknown = 1 - sum(d1[min(c, top)] * c for c in words.values()) / total
    if unknown <= 1e-12:
        unknown, d1 = 1 / (total + 1), d1 * total / (total + 1)
    back = {}

    def chance(h, w):
        if not h:
            return d1[min(words[w], top)] * words[w] / total if w in words else unknown
        m = grams[len(h)].get(h)
        if m is None:
            return chance(h[1:], w)
        if h not in back:
            size = sum(m.values())
            left = size - sum(d[len(h)][min(c, top)] * c for c in m.values())
            if left <= 1e-9 * size:
                size, left = size + 1, 1
            back[h] = size, left / size / (1 - sum(chance(h[1:], x) for x in m))
        if w in m:
            return d[len(h)][min(m[w], top)] * m[w] / back[h][0]
        return back[h][1] * chance(h[1:], w)

    # Every history's probabilities sum to one.
    for table in grams[1:]:
        for h in list(table)[:30]:
            assert math.isclose(sum(chance(h, w) for w in [*words, "?"]), 1, rel_tol=1e-9)
    out = []
    for (i, w), o in zip(texts, held):
        base = sum(math.log10((words[x] + 0.1) / (total + 0.1 * (types + 1))) for x in w)
        score = sum(math.log10(chance(histories(w, p)[-1], x)) for p, x in enumerate(w))
        out.append((i, o, len(w), sum(x in words for x in w), total, base, score))
    return out


def same_scores(got, want):
    got, want = (sorted(map(tuple, rows), key=repr) for rows in (got, want))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("order, bucket", [(2, 40), (3, katz.BUCKET), (3, 40), (4, 40)])
def test_katz_scores(documents, order, bucket):
    rng = np.random.default_rng(2)
    common = ["the"] * 30 + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(common, 40))) for i in range(60)] + ODD
    # Held-out texts that share long histories with the others, and go on otherwise.
    rows += [(200 + i, f"the cat sat on the mat {i % 3} times") for i in range(40)]
    docs = documents(*rows, extra=["chunk", "bucket", "words", "held_out"])
    got = katz.katz_scores(docs, bucket=bucket, order=order).collect()
    same_scores(got, brute_katz(rows, order))


def test_katz_of_texts_that_are_all_empty(documents):
    rows = [(i, None if i % 2 else "") for i in range(20)]
    same_scores(katz.katz_scores(documents(*rows), order=3).collect(), brute_katz(rows))


def test_katz_needs_an_order_of_two(empty):
    with pytest.raises(ValueError, match="order"):
        katz.katz_scores(empty, order=1)


def test_a_bucket_has_each_ngram_once_per_chunk(documents, monkeypatch):
    rows = [(i, "one short text") for i in range(2000)] + [(5000 + i, f"w{i} w") for i in range(50)]
    docs = documents(*rows)
    largest, count = [], katz.count_classes

    def counted(parcels, *rest):
        found = parcels.collect()
        assert len({r.chunk for r in found}) <= docs.rdd.getNumPartitions()
        sizes = Counter()
        for r in found:
            sizes[r.bucket] += len(katz.unpacked(r.words))
        largest.append(max(sizes.values()))
        return count(parcels, *rest)

    monkeypatch.setattr(katz, "count_classes", counted)
    got = katz.katz_scores(docs, bucket=40).collect()
    assert len(largest) == 2 and max(largest) < 200
    same_scores(got, brute_katz(rows))


def test_distinct_keys_of_ngrams():
    keys = np.random.default_rng(3).integers(0, 50, 400)
    for some in (keys, keys[:1], keys[:0]):
        found, place, number = katz.distinct(some)
        assert found.tolist() == sorted(set(some.tolist()))
        assert (some[place] == found).all() and (found[number] == some).all()


def test_katz_gathers_from_stored_answers(documents):
    docs = documents(*[(i, f"some words {i % 7} of text {i % 3}") for i in range(60)])
    plan = katz.katz_scores(docs)._jdf.queryExecution().optimizedPlan().toString()
    # The n-grams are not met again: two stored tables meet by chunk, nothing else.
    assert plan.count("FlatMapCoGroups") == 1


def test_katz_asks_ngrams_once_and_keeps_none(documents, monkeypatch):
    docs = documents(*[(i, f"some words {i % 7} of text {i % 3}") for i in range(60)])
    places, asked, store, answer = [], [], katz.in_parts, katz.answer_chunks

    def answered(parcels, *rest):
        asked.extend((len(places), r.bucket) for r in parcels.select("bucket").distinct().collect())
        return answer(parcels, *rest)

    monkeypatch.setattr(katz, "in_parts", lambda *a: places.append(store(*a)) or places[-1])
    monkeypatch.setattr(katz, "answer_chunks", answered)
    katz.katz_scores(docs)
    assert len(places) == 2 and len(asked) == len(set(asked))
    # What the chunks keep is all that is left of the last order.
    assert [p.name for p in Path(places[-1].removeprefix("file:")).glob("part=*")] == [f"part={katz.PARTS}"]


def test_hashes_of_words():
    def plain(word):
        factor, value = int(shingles._FACTOR), 0
        for i, c in enumerate(word.lower() if word.isascii() else word):
            value += (c + 1) * factor**i
        return int(shingles.mix(np.array([(value + len(word)) % 2**64], np.uint64))[0])

    long = b"x" * (shingles.STRETCH + 9)
    for data in (b"", b" ", b"A", b" Zz@[`{ a\tb\x0bc \x0e\xc3\x84 ", b"one two\r\nONE", b"ab " + long[:4000] + b"\n"):
        hashes, places = shingles.hash_words(data)
        assert hashes.tolist() == [plain(w) for w in data.split()]
        assert [data[p : p + 1] for p in places] == [w[:1] for w in data.split()]
    first, second = (shingles.hash_words(d)[0] for d in (long + b" yes", b"no yes"))
    assert len(first) == 2 and first[1] == second[1]


def test_katz_of_an_empty_table(empty):
    assert katz.katz_scores(empty).count() == 0


def test_discounts_are_proper():
    for times in ([100, 40, 20, 12, 8, 5], [10, 30, 1, 0, 9, 2], [5, 0, 0, 0, 0, 0], [0] * 6):
        d = katz.discounts(times)
        assert ((d[1:-1] > 0) & (d[1:-1] < 1)).all() and d[-1] == 1


# Nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int"


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    known = rng.normal(size=(1500, 16)).astype(np.float32)
    # A crowd of equal vectors, ties, and a repeated row.
    known[200:700] = known[200]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(known)]
    rows += [rows[5], (2000, None, 0), (2100, [0.0] * 16, 0), (2200, [float("nan")] + [1.0] * 15, 0)]
    rows += [(2300, [1.0, None] + [1.0] * 14, 0), (2400, [1.0], 0), (None, [1.0] * 16, 0)]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS list", "2 AS part", "3 AS v")
    got = neighbours.neighbours(frame, queries.F.col("vec_id") % 100 == 0).collect()
    found = defaultdict(list)
    for row in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found[row.query_id].append((row["rank"], row.vec_id, row.score))
    assert sorted(found) == list(range(0, 1500, 100))
    hits = 0
    exact_ids = known.astype(float)
    for query, near in found.items():
        distance = np.sqrt(((exact_ids - exact_ids[query]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(1500), distance)) if i != query][:10]
        assert [r for r, _, _ in near] == list(range(1, 11))
        assert [(s, i) for _, i, s in near] == sorted((s, i) for _, i, s in near)
        assert all(math.isclose(distance[i], s, abs_tol=1e-12) for _, i, s in near)
        hits += len(set(order) & {i for _, i, _ in near})
    assert hits >= 0.9 * 10 * len(found)


def exact_neighbours(rows, query, k=10):
    """(vec_id, distance) with each id at the smallest distance of any of its and the query's rows."""
    best = {}
    for _, asked in (r for r in rows if r[0] == query):
        for i, v in rows:
            if i != query:
                far = math.dist(asked, v)
                best[i] = min(far, best.get(i, far))
    return sorted(best.items(), key=lambda x: (x[1], x[0]))[:k]


@pytest.mark.parametrize("copies, near, far", [(40, 0.1, 1.0), (2000, 0.01, 10.0)])
def test_rows_of_one_id_take_one_place(spark, copies, near, far):
    rng = np.random.default_rng(4)
    rows = [(0, [0.001] * 8)]
    # Some rows of an id lie nearer than all others; in the larger case they fill whole lists.
    rows += [(7, (near * rng.normal(size=8)).tolist()) for _ in range(copies)]
    rows += [(100 + i, [far, *rng.normal(size=7).tolist()]) for i in range(30)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], VECTORS.replace("float", "double"))
    got = neighbours.neighbours(frame, queries.F.col("vec_id") == 0).orderBy("rank").collect()
    want = exact_neighbours(rows, 0)
    assert [r.vec_id for r in got] == [i for i, _ in want]
    assert [r.score for r in got] == pytest.approx([d for _, d in want], rel=1e-9)


@pytest.mark.parametrize("dimensions, spread", [(16, 0), (64, 0), (8, 40)])
def test_recall_with_many_lists(spark, monkeypatch, dimensions, spread):
    # As many lists as a table of a million vectors has here; Gaussian, or in clusters.
    monkeypatch.setattr(neighbours, "LIST_SIZE", 64)
    rng = np.random.default_rng(dimensions)
    known = rng.normal(size=(20_000, dimensions))
    if spread:
        known += spread * rng.normal(size=(200, dimensions))[rng.integers(0, 200, len(known))]
    frame = spark.createDataFrame(
        [(i, v.tolist(), 0) for i, v in enumerate(known)], VECTORS.replace("float", "double")
    )
    got = defaultdict(set)
    for row in neighbours.neighbours(frame, queries.F.col("vec_id") % 400 == 0).collect():
        got[row.query_id].add(row.vec_id)
    hits = 0
    for query in range(0, len(known), 400):
        far = ((known - known[query]) ** 2).sum(axis=1)
        far[query] = np.inf
        hits += len(got[query] & set(np.argsort(far)[:10].tolist()))
    assert hits >= 0.95 * 10 * len(got)


@pytest.mark.parametrize("size", [1e200, 1e-200])
def test_huge_and_tiny_components(spark, size):
    rng = np.random.default_rng(2)
    rows = [(i, (size * rng.normal(size=4)).tolist()) for i in range(120)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], VECTORS.replace("float", "double"))
    got = neighbours.neighbours(frame, queries.F.col("vec_id") == 0).orderBy("rank").collect()
    want = exact_neighbours([(i, [x / size for x in v]) for i, v in rows], 0)
    assert [r.vec_id for r in got] == [i for i, _ in want]
    assert [r.score / size for r in got] == pytest.approx([d for _, d in want], rel=1e-9)


def test_few_vectors(spark):
    rows = [(0, [1.0, 0.0], 0), (100, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    frame = spark.createDataFrame(rows, VECTORS)
    got = neighbours.neighbours(frame, queries.F.col("vec_id") % 100 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [
        (0, 1, 3), (0, 2, 100), (100, 1, 3), (100, 2, 0)
    ]
    none = spark.createDataFrame([], VECTORS)
    assert neighbours.neighbours(none, queries.F.col("vec_id") % 100 == 0).count() == 0
    assert neighbours.neighbours(frame, queries.F.col("vec_id") == 77).count() == 0


# Chats

HARD = "</s>[INST] ok [/INST]"


def test_chats(spark):
    turns = [
        (1, 0, "system", "be \\ brief"),
        (1, 2, "assistant", f"a {HARD} \\[ \\\\"),
        (1, 1, "user", HARD),
        (1, 3, "assistant", ""),
        (1, 4, "assistant", "again 🎉 é́\n "),
        (2, 0, "user", None),
        (2, 1, "assistant", None),
        (2, 1, "assistant", "twice"),
        (2, 1, "assistant", "twice"),
        (3, None, None, "<<TURN>>tool<<TEXT>>x<</TURN>>"),
        (3, 5, "tool<<TEXT>>", "  [\\INST]  "),
        (None, 0, "assistant", " leading <|endoftext|>"),
        (4, 0, "assistant", "long " * 20_000),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "1 AS turns", "2 AS formatted")
    formatted = chat.format_chats(frame)
    got = {r.conv_id: r for r in chat.read_chats(formatted).collect()}
    assert len(got) == 5
    text = {r.conv_id: r.formatted for r in formatted.collect()}
    for conv in got:
        mine = [t for t in turns if t[0] == conv]
        mine.sort(key=lambda t: (t[1] is not None, t[1], t[2] or "", t[3] or ""))
        told = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in mine)
        loss = "".join(t or "" for _, _, r, t in mine if r == "assistant")
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == sha256(told.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss)
        assert got[conv].loss_sha256 == sha256(loss.encode()).hexdigest()
        assert got[conv].formatted_chars == len(text[conv])
        assert chat.parse(text[conv]) == [(r or "", t or "") for _, _, r, t in mine]


def test_chats_of_an_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_chats(chat.format_chats(frame)).count() == 0


# Languages


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_held_out_languages(spark):
    got = queries.op9_language(spark, DATA)
    lang = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = got.join(lang, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_texts_of_no_learned_language_are_rejected(documents):
    rng = np.random.default_rng(3)
    words = {
        "en": "the of and to in that is was for on as with his they at be this from have or by one had not but "
              "what all were when there can an your which their said if do will each about how up out them then "
              "she many some so these would other into has more her two like him see time could no make than first",
        "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden "
              "aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur "
              "oder aber vor zur bis mehr durch man sein wurde sei kann gegen vom können schon wenn habe seine",
    }

    def text(lang, size):
        return " ".join(rng.choice(words[lang].split(), size))

    rows = [(i, text(("en", "de")[i % 2], int(rng.integers(8, 300))), ("en", "de")[i % 2]) for i in range(900)]
    model = language.fit(documents(*rows, extra=["chosen_id", "place", "id", "label"]))
    held = [(i, text(("en", "de")[i % 2], int(rng.integers(8, 300)))) for i in range(1000, 1600)]
    got = language.predict(documents(*held), model).collect()
    assert sum(r.lang_pred == ("en", "de")[r.doc_id % 2] for r in got) >= 0.99 * len(held)
    assert sum(not r.rejected for r in got) >= 0.99 * len(held)
    others = [
        "これは日本語の文章です。私たちは毎日ご飯を食べます。東京は大きな都市で、人々は電車に乗って仕事に行きます。",
        "Это русский текст, который не относится ни к одному из изученных языков, и его следует отклонить сразу.",
        "xqzv jkwpt bvrnq zzkx wqpfh gjkl vbnmx qwrtp zxcvb plkjh mnbvq wqzxr tgbvf yhnuj qzwsx",
    ] * 20
    got = language.predict(documents(*[(i, t) for i, t in enumerate(others)]), model).collect()
    assert all(r.rejected for r in got)
    kept = language.keep_known(documents(*held, *[(i, t) for i, t in enumerate(others)]), model)
    assert min(r.doc_id for r in kept.collect()) >= 1000


def test_languages_of_odd_rows(documents, odd, empty):
    rows = [(i, f"the and of that {i}", "en") for i in range(40)]
    rows += [(100 + i, f"der und die das {i}", "de") for i in range(40)]
    model = language.fit(documents(*rows, (900, None, "xx"), (901, "1 2", "yy"), (902, "a", None)))
    assert model.names == ["de", "en"]
    got = language.predict(odd, model).collect()
    assert len(got) == len(ODD)
    for row in got:
        text = [t for i, t in ODD if i == row.doc_id]
        letters = any(c.isalpha() for t in text for c in t or "")
        if row.doc_id is not None:
            assert (row.lang_pred == "und") == (not letters)
    assert language.keep_known(odd, model).columns == odd.columns
    assert language.fit(empty) is None
    assert {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


# Pipeline


def test_pipeline(spark, documents, tmp_path):
    long_text = "the quick and the slow of that " * 40
    words = [" ".join(f"the{i}x{j} of" for j in range(60)) for i in range(12)]
    rows = [(i, t, "en") for i, t in enumerate(words)]
    rows += [(20, words[3] + "  ", "en"), (21, words[4] + " more", "en"), (22, "123 456", "en")]
    rows += [(23, None, "en"), (24, long_text, "en"), (25, "", None), (24, long_text, "en")]
    documents(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {*range(12), 24}
    # The repeated row is packed once.
    tokens = {r.doc_id: r.doc_tokens for r in got}
    assert sum(r.length for r in got) == sum(tokens.values())


def test_pipeline_of_an_empty_table(spark, documents, tmp_path):
    documents((1, "x")).where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
