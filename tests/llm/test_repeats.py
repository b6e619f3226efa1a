"""Substring and suffix dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, odd_texts, rows_of, with_clashes, words_of

from eventmill.llm import anchors
from eventmill.llm.hashing import BYTE_UNITS
from eventmill.llm.substring_dedup import substring_dedup
from eventmill.llm.suffix_dedup import suffix_dedup
from eventmill.llm.suffix_order import Cover, SuffixBlock, difference_cover


def brute_substring(rows, length):
    order = {None: 1 << 70}
    first: dict[tuple, int] = {}
    docs = [(order.get(r[0], r[0]), r[0], words_of(r[1])) for r in rows]
    for rank, _, words in docs:
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            first[key] = min(first.get(key, rank), rank)
    out = []
    for rank, doc_id, words in docs:
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < rank:
                gone[i : i + length] = [True] * length
        out.append((doc_id, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=str)


def brute_suffix(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    found = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if found[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(text), sum(gone), spans, bytes(c for c, g in zip(text, gone) if not g)))
    return sorted(out, key=str)


def run_substring(docs, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(docs, **options).collect()), key=str)


def run_suffix(docs, **options):
    cut = suffix_dedup(docs, **options).collect()
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in cut)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in cut), key=str)


ODD = rows_of(*odd_texts())


@pytest.mark.parametrize("length, gram", [(50, 20), (12, 4), (3, 3)])
def test_substring_dedup_is_exact(spark, length, gram):
    found = run_substring(with_clashes(documents(spark, ODD)), length=length, gram=gram)
    assert found == brute_substring(ODD, length)
    assert sum(r[2] for r in found)


@pytest.mark.parametrize("length, gram, most", [(200, 50, 2000), (200, 50, 1), (40, 10, 3), (17, 8, 2000)])
def test_suffix_dedup_is_exact(spark, length, gram, most):
    found = run_suffix(with_clashes(documents(spark, ODD)), length=length, gram=gram, most=most)
    assert found == brute_suffix(ODD, length)
    assert sum(r[2] for r in found)


def test_repeated_rows_and_missing_ids(spark):
    text = odd_texts()[6]
    rows = [(7, text, "en", "s", 1), (7, text, "en", "s", 1), (None, text, None, None, None), (9, text + " more", "en", "s", 1)]
    assert run_substring(documents(spark, rows)) == brute_substring(rows, 50)
    assert run_suffix(documents(spark, rows)) == brute_suffix(rows, 200)


def test_rows_that_share_an_id_but_not_the_text(spark):
    texts = odd_texts()
    rows = [(3, texts[6], "en", "s", 1), (3, texts[10], "en", "s", 1), (4, texts[11], "en", "s", 1)]
    found = run_suffix(documents(spark, rows))
    assert found == brute_suffix(rows, 200)
    assert run_substring(documents(spark, rows)) == brute_substring(rows, 50)


def test_many_rows_share_an_id(spark):
    """Half without an id, half of one id; some repeat each other, some an earlier document."""
    rng = random.Random(11)
    passages = [" ".join(str(rng.randrange(10**6)) for _ in range(60)) for _ in range(6)]
    texts = [f"{rng.random()} {rng.choice(passages)} {rng.choice(passages)} {i % 40}" for i in range(1000)]
    rows = [(None if i % 2 else 5, t, "en", "s", 1) for i, t in enumerate(texts)] + [(1, passages[0], "en", "s", 1), (9, passages[1] + " x", "en", "s", 1)]
    docs = documents(spark, rows)
    assert run_substring(docs) == brute_substring(rows, 50)
    assert run_suffix(docs) == brute_suffix(rows, 200)


def test_checksums_that_clash(spark):
    """Two texts without an id, equal in the low bits of their CRC-32, one of them repeated under an id."""
    rng = random.Random(12)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(60))
    other = next(t for i in range(10**6) if (zlib.crc32((t := f"{i} " + text[::-1]).encode()) ^ zlib.crc32(text.encode())) & 4095 == 0)
    rows = [(None, other, "en", "s", 1), (None, text, "en", "s", 1), (1, text, "en", "s", 1)]
    assert run_substring(documents(spark, rows)) == brute_substring(rows, 50)
    assert run_suffix(documents(spark, rows)) == brute_suffix(rows, 200)
    assert [r[2] for r in run_substring(documents(spark, rows)) if r[0] is None] == [0, 60] or [r[2] for r in run_substring(documents(spark, rows)) if r[0] is None] == [60, 0]


def test_empty_tables(spark):
    assert run_substring(documents(spark, [])) == []
    assert run_suffix(documents(spark, [])) == []
    assert [r[1:3] for r in run_suffix(documents(spark, rows_of(None, "")))] == [(0, 0), (0, 0)]
    assert [r[1:3] for r in run_substring(documents(spark, rows_of(None, "")))] == [(0, 0), (0, 0)]


def test_a_passage_in_every_document(spark):
    rng = random.Random(4)
    shared = " ".join(str(rng.random()) for _ in range(60))
    rows = rows_of(*(f"{rng.random()} {shared} {rng.random()}" for _ in range(120)))
    assert run_substring(documents(spark, rows)) == brute_substring(rows, 50)
    for most in (2000, 10):
        assert run_suffix(documents(spark, rows), most=most) == brute_suffix(rows, 200)


def test_whole_characters_and_carried_columns(spark):
    shared = "é" * 150
    rows = rows_of("xy" + shared + "è", "z" + shared + "ê")
    cut = suffix_dedup(documents(spark, rows), whole=True, carried=("lang", "source")).collect()
    assert {r.doc_id: bytes(r.kept).decode() for r in cut} == {0: "xyè", 1: "zê"}
    assert {r.carried.lang for r in cut} == {"en"}


def test_a_text_longer_than_a_chunk_is_cut_into_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 9000, dtype=np.uint8)
    units, ends = BYTE_UNITS[data], np.array([3000, 8990, 9000])
    whole = [a for a in anchors.scan(units, ends, 60, 12)]
    monkeypatch.setattr(anchors, "CHUNK", 2048)
    parts = [a for a in anchors.scan(units, ends, 60, 12)]

    def windows(found):
        """Every window with its anchor."""
        return {(t, f + i, f + o) for a in found for t, f, o, n in zip(a.text, a.first, a.offset, a.count) for i in range(n)}

    assert windows(whole) == windows(parts)
    assert len(windows(whole)) == 2941 + 5931


def test_spots_are_packed_without_loss():
    first, offset, count = np.array([0, 5, 2**31 - 1]), np.array([0, 1023, 17]), np.array([1, 900, 1023])
    tag = np.array([0, 4095, 77])
    assert [x.tolist() for x in anchors.unpack(anchors.pack(first, offset, count, tag))] == [x.tolist() for x in (first, offset, count, tag)]


@pytest.mark.parametrize("v", [8, 32, 57])
def test_difference_cover_has_all_differences(v):
    cover = difference_cover(v).tolist()
    assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("length", [16, 40, 64, 200, 333])
def test_suffix_order_is_the_order_of_the_strings(length):
    rng = random.Random(length)
    base = bytes(rng.choice(b"ab") for _ in range(600))
    text = b"".join(base[rng.randrange(300) :][: rng.randrange(50, 300)] + b"c" for _ in range(40)) + b"a" * 500 + b"ab" * 300
    places = np.array([rng.randrange(len(text) - length) for _ in range(1500)])
    buckets = np.array([rng.randrange(3) for _ in places])
    classes = SuffixBlock(text, length, Cover(length)).classes(places, buckets)
    for bucket in range(3):
        names: dict[bytes, int] = {}
        for i in np.flatnonzero(buckets == bucket):
            assert names.setdefault(text[places[i] : places[i] + length], classes[i]) == classes[i]
        assert [names[s] for s in sorted(names)] == sorted(set(names.values()))


def test_query_digests(spark, tmp_path):
    from eventmill.llm.queries import op1_substring_dedup, op8_suffix_dedup

    documents(spark, ODD).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.kept_sha256 for r in op1_substring_dedup(spark, str(tmp_path)).collect()}
    assert found == {r[0]: hashlib.sha256(r[3].encode()).hexdigest() for r in brute_substring(ODD, 50)}
    found = {r.doc_id: (r.n_spans, r.kept_sha256) for r in op8_suffix_dedup(spark, str(tmp_path)).collect()}
    assert found == {r[0]: (r[3], hashlib.sha256(r[4]).hexdigest()) for r in brute_suffix(ODD, 200)}


def test_substring_dedup_of_a_text_cut_into_pieces(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(1 << 40)}" for _ in range(anchors.CHUNK // 2 + 60_000)]
    passage = [f"p{i}" for i in range(160)]
    long = [*words[:1000], *passage, *words[1000 : anchors.CHUNK // 2 + 30_000], *passage, *words[anchors.CHUNK // 2 + 30_000 :], *passage[:70]]
    rows = rows_of(" ".join(long), " ".join([*words[:30], *passage]), " ".join(words[5000:5100]), first=5)
    docs = documents(spark, rows)
    assert run_substring(docs, length=20, gram=8) == brute_substring(rows, 20)
