"""Token files, packing, counts and pieces against the public libraries."""

import io
import zlib

import numpy as np
import pytest
import zstandard

from airwave.llm import packing, token_counts, token_files, tokens
from airwave.llm.pieces import MODEL, Pieces, decode_pieces, encode_pieces
from tests.llm.conftest import ODD

TEXTS = [t or "" for _, t in ODD] + [
    "a.\nb! c\nd",
    "ab\n\nc  d.\n \n e\n",
    " lead",
    "trail ",
    "a　 b  c\x85 d​ e",
    "İX ΣΑΣ ß don't'S",
    " " * 50 + "q",
    "x<|endoftext|> y <|startoftext|>z",
]


def words(n, seed=0):
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdeéß .,\n'12"))
    return "".join(rng.choice(letters, n))


@pytest.fixture(scope="module")
def library():
    return tokens.tokenizer(tokens.BYTE_BPE)


def expected(library, text, end):
    return library.encode(text, add_special_tokens=False).ids + [end]


def test_ids_equal_the_library(library):
    texts = TEXTS + [words(3000, s) for s in range(5)]
    found = tokens.ByteIds().batch(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == expected(library, text, 0)[:-1]


def test_stretches_and_forgetting_change_nothing(library, monkeypatch):
    text = " ".join(TEXTS) * 3
    assert "".join(tokens.stretches(text, 40)) == text
    monkeypatch.setattr(tokens, "STRETCH", 40)
    encoder = tokens.ByteIds(remembered=50)
    for _ in range(4):
        got = np.frombuffer(encoder.batch([text])[0], "<u4").tolist()
        assert got == expected(library, text, 0)[:-1]


def test_token_files(spark, odd, library, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(odd, path)
    rows = token_files.token_index(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i))
    before = 0
    for row in rows:
        assert row.start == before
        before += row.n_tokens
    known = {i: expected(library, t or "", 2) for i, t in ODD if i is not None}
    for row in rows:
        if row.doc_id is not None:
            ids = np.array(known[row.doc_id], "<u4")
            assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


def test_reader_takes_only_what_is_asked(spark, documents, library, tmp_path):
    path = tmp_path / "files"
    docs = documents(*[(i, words(400, i)) for i in range(30)])
    token_files.write_token_files(docs, str(path))
    found = {}
    for file in sorted(path.glob("part-*")):
        data = file.read_bytes()
        if not data:
            continue
        stream = io.BytesIO(data)
        one = token_files.TokenFile(stream)
        taken = []
        read, stream.read = stream.read, lambda n: taken.append(n) or read(n)
        for doc_id, ids in one.find([3, 17, 99]):
            found[doc_id] = ids.tolist()
        assert sum(taken) < len(data) / 3
        # Any decoder reads the whole file.
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
        assert whole.read() == b"".join(one.ids(i) for i in range(len(one.doc_ids)))
        broken = bytearray(data)
        broken[int(one.starts[0]) + 12] ^= 1
        with pytest.raises((ValueError, zstandard.ZstdError)):
            token_files.TokenFile(io.BytesIO(bytes(broken))).ids(0)
    assert found == {i: expected(library, words(400, i), 2) for i in (3, 17)}


def test_token_files_of_an_empty_table(spark, empty, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(empty, path)
    assert token_files.token_index(spark, path).count() == 0


def check_pieces(rows, docs, library, capacity):
    ids = {}
    for row in rows:
        ids.setdefault((row.doc_id, row.doc_tokens), []).append(row)
    windows = {}
    for row in rows:
        windows.setdefault(row.sequence_id, []).append(row)
    for window in windows.values():
        at = 0
        for row in sorted(window, key=lambda r: r.offset):
            assert row.offset == at and len(row.ids) == 4 * row.length > 0
            at += row.length
        assert at <= capacity
    for doc_id, text in docs:
        got = sorted(
            (r for r in rows if r.doc_id == doc_id), key=lambda r: (r.doc_tokens, r.start)
        )
        joined = b"".join(r.ids for r in got)
        want = np.array(expected(library, text or "", 1), "<u4").tobytes()
        assert want in joined
    return windows


def test_packing(odd, library):
    rows = packing.pack(odd).collect()
    check_pieces(rows, ODD, library, 2048)
    total = sum(len(expected(library, t or "", 1)) for _, t in ODD)
    assert sum(r.length for r in rows) == total


def test_packing_leaves_little_room(documents, library):
    docs = [(i, words(200 + 37 * i % 900, i)) for i in range(300)]
    rows = packing.pack(documents(*docs), capacity=256, windows=64, piece=64).collect()
    windows = check_pieces(rows, docs, library, 256)
    assert sum(r.length for r in rows) / (256 * len(windows)) > 0.97


def test_packing_an_empty_table(empty):
    assert packing.pack(empty).count() == 0


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(0).integers(1, 100, 400).tolist()
    groups = packing.differencing(sizes, 20)
    assert sorted(i for g in groups for i in g) == list(range(400))
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert max(sums) - min(sums) <= 3
    # Three items over half the room cannot share two windows: the count rises.
    assert len(packing.balanced([60, 60, 60], 100)) == 3


def test_counts(odd):
    rows = token_counts.count_tokens(odd, limit=100).collect()
    library = tokens.tokenizer(tokens.WORD_BPE)
    want = []
    for i, t in ODD:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 100))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("chunk,overlap", [(64, 20), (200, 40), (500, 33)])
def test_splicing_is_exact(chunk, overlap):
    library = tokens.tokenizer(tokens.WORD_BPE)
    splicer = token_counts.Splicer(chunk=chunk, overlap=overlap)
    odd = ["x" * 3000, "a'b" * 900, " <|startoftext|>" * 90, "<|endoftext|>" * 90, "é́" * 500]
    for text in [" ".join(TEXTS), *odd, "日本" * 400 + " ok " * 50, words(4000)]:
        assert splicer.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_counts_of_an_empty_table(empty):
    assert token_counts.count_tokens(empty).count() == 0


def test_pieces_equal_the_library(odd):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary_path(MODEL))
    own = Pieces()
    texts = TEXTS + [words(2000, s) for s in range(3)] + ["<s> <unk> ▁▁x  y", "a" * 300]
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(want) == library.decode(want)
    rows = decode_pieces(encode_pieces(odd)).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    for i, text in ODD:
        if i is not None and "▁" not in (text or ""):
            assert by_id[i].text == (text or "")


def test_pairs_of_pieces_are_judged_from_the_merges_inside_each(monkeypatch):
    pytest.importorskip("sentencepiece")
    own, merges, run = Pieces(), Pieces.merges, []
    known = sorted(own.usable)
    lefts = known[::701] + ["a", "▁", "\x00", "日", "▁th", "er"]
    rights = known[1::907] + ["a", "\x00", "日", "er", "ing", "e"]
    for left in lefts:
        for right in rights:
            assert own.follows(left, right) == (own.merged(left + right) == [left, right])
    own = Pieces()
    monkeypatch.setattr(own, "merges", lambda text: run.append(text) or merges(own, text))
    own.encode([words(3000, seed) for seed in range(3)])
    assert run and len(run) == len(set(run))
    assert all(text in own.usable or len(text) == 1 for text in run)


def test_pieces_of_an_empty_table(empty):
    assert decode_pieces(encode_pieces(empty)).count() == 0


def test_marks_after_letters_and_other_ends(library):
    texts = [f"{w}{m} next" for w in ("word", "é", "12", "a.", "日本", "it's", "ß", "x²", "") for m in (".", ",", "!?", "?\nNew", "\n")]
    texts += [f"a {t}" for t in texts] + ["..., ,,, a,b, c.\nd e", "ends with,", "q.", "."]
    for text, ids in zip(texts, tokens.ByteIds().batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == expected(library, text, 0)[:-1], text


def test_known_parts_are_bounded_in_bytes():
    encoder = tokens.ByteIds(remembered=200_000)
    for i in range(40):
        encoder.batch(["語" * 2000 + str(i), " ".join(f"w{i}x{j}" for j in range(300))])
        # A batch is learned whole; then all is forgotten once it is too much.
        assert encoder.held < 400_000 and 4 * len(encoder.ids) < encoder.held


def test_packing_many_tiny_texts_holds_few_items(documents, monkeypatch):
    most = []
    real = packing.differencing

    def noted(sizes, k):
        most.append((len(sizes), k))
        return real(sizes, k)

    monkeypatch.setattr(packing, "differencing", noted)
    docs = documents(*[(i, "" if i % 3 else None) for i in range(3000)])
    table = packing.texts(docs).toArrow()
    # In this process, as workers would not report what they hold.
    monkeypatch.setattr(packing, "in_tasks", lambda df, run, schema, keeps=None: run)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda s: 0})())
    rows = [r for b in packing.pack(docs)(table.to_batches()) for r in b.to_pylist()]
    assert len(rows) == 3000 and {r["length"] for r in rows} == {1}
    assert len({r["sequence_id"] for r in rows}) == 2
    assert max(n for n, _ in most) <= 6
    for window in (0, 1):
        offsets = sorted(r["offset"] for r in rows if r["sequence_id"] == window)
        assert offsets == list(range(len(offsets)))
