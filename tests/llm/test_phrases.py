"""Phrases by brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from airwave.llm import phrases

LOWER = {i: i + 32 for i in range(65, 91)}
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, longest=4, least=30, top=2000, share=80):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, g), a in candidates.items():
        for n in range(2, len(g)):
            for i in range(len(g) - n + 1):
                part = lang, g[i : i + n]
                if part in candidates and 100 * a >= share * candidates[part]:
                    gone.add(part)
    found = []
    for (lang, g), a in candidates.items():
        if (lang, g) not in gone:
            cuts = []
            for k in range(1, len(g)):
                l, r = counts[lang, g[:k]], counts[lang, g[k:]]
                cuts.append((2_000_000 * a // (l + r), k, l, r))
            score, _, l, r = min(cuts)
            found.append((lang, -score, -a, " ".join(g).encode(), l, r))
    out, last, rank = [], None, 0
    for lang, score, a, phrase, l, r in sorted(found):
        rank = rank + 1 if lang == last else 1
        last = lang
        if rank <= top:
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def made(seed, docs, words="a b c d e f A B, c. tt\tuu é ñ; x"):
    draw = random.Random(seed)
    words = words.split(" ")
    return [
        (i, " ".join(draw.choices(words, k=draw.randrange(0, 60))), draw.choice(["en", "de", None]))
        for i in range(docs)
    ]


def test_phrases_equal_brute_force(documents):
    rows = made(1, 120)
    # A third of all rows are copies of one text; words repeat inside it.
    rows += [(500 + i, "one two one two one two three. One TWO", "en") for i in range(60)]
    pairs = [(lang, text) for _, text, lang in rows]
    docs = documents(*rows, extra=["a", "n", "id", "left", "right", "chunk", "seq", "phrase", "rank"])
    for least, share, longest in ((5, 80, 4), (20, 50, 4), (3, 100, 3), (8, 80, 2)):
        got = phrases.collocations(docs, longest, least, 2000, share, chunk=700, bucket=300)
        assert rows_of(got) == brute(pairs, longest, least, 2000, share)


def test_ties_and_top(documents):
    rows = [(i, "b c. a b. c d. d e", "en") for i in range(40)]
    want = brute([(lang, text) for _, text, lang in rows], top=2)
    assert rows_of(phrases.collocations(documents(*rows), top=2)) == want
    # All bigrams occur equally often; the scores of three are equal, and bytes decide.
    assert [w[2] for w in want] == ["a b", "d e"]


def test_odd_and_empty_tables(odd, empty):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert rows_of(phrases.collocations(odd)) == brute(rows)
    assert rows_of(phrases.collocations(odd, least=1)) == brute(rows, least=1)
    assert rows_of(phrases.collocations(empty)) == []


def test_a_huge_document_is_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 64)
    text = "one two three. four five, six " * 200
    given = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    out = [r for b in phrases.cut_words([given], 7, 500) for r in b.to_pylist()]
    assert len({r["chunk"] for r in out}) > 5
    counts = Counter()
    for r in out:
        if r["words"]:
            numbers = phrases.unpack(r["counts"], np.int64).tolist()
            counts.update(dict(zip(r["words"], numbers, strict=True)))
            assert r["total"] == sum(numbers)
    assert counts == {w: 200 for w in "one two three four five six".split()}


def test_gaps_do_not_join():
    places, ids = np.array([0, 1], np.int32), np.array([70, 71])
    seq = np.array([0, 1, 2, 0, -1, 1, 0, 1], np.int32)
    *pairs, sequence = phrases.pair_up(9, seq, places, ids, 1, False)
    (row,) = pairs[0].to_pylist()
    left, right, counts = (phrases.unpack(row[c], np.int64).tolist() for c in ("left", "right", "counts"))
    assert (np.cumsum(left).tolist(), right, counts) == ([70, 71], [71, 70], [2, 1])
    assert phrases.unpack(sequence.column("seq")[0].as_py(), np.int32).tolist() == [0, -1, 1, 0]


def test_numbers_survive_packing():
    for kind in (np.int32, np.int64):
        for numbers in ([], [0], [-1, 5, np.iinfo(kind).max, np.iinfo(kind).min]):
            given = np.array(numbers, kind)
            assert phrases.unpack(phrases.pack(given), kind).tolist() == numbers
