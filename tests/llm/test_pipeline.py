"""The pipeline: what each stage does to its own input, and all of them together."""

from __future__ import annotations

import random

import pytest
from cases import documents, words_of
from test_groups import brute_print
from test_repeats import brute_suffix

import corpus_pipeline
from eventmill.llm import stages

LABELS = "doc_id long, quality int, toxic int"


def corpus():
    rng = random.Random(12)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ri", "sa", "te") for b in ("dan", "for", "gel", "hin", "jas", "kom", "lut")]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, item = prose(60), prose(30)
    texts = {i: prose(rng.randrange(30, 90)) for i in range(60)}
    texts |= {100: texts[3], 101: texts[3], 102: texts[5] + " more", 110: "you idiot " + prose(40), 111: prose(30) + " what a moron you are"}
    texts |= {120 + i: f"{prose(20)} {passage} {prose(20)}" for i in range(4)}
    texts |= {130: f"{prose(20)} {item} {prose(20)}", 140: "", 141: None}
    rows = [(i, t, "en", f"src{i % 3}", len(t) if t is not None else None) for i, t in texts.items()]
    labels = [(i, 1, int(i in (110, 111))) for i in texts if i % 2 or i >= 100]
    return rows, labels, [(0, item), (1, prose(30))], passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels, items, _ = corpus()
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_on_its_own_input(spark, folder):
    rows, _, _, passage = corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = stages.toxicity(spark, docs, folder)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {110, 111}
    one = stages.simhash_near_dedup(spark, docs, folder)
    left = {r.doc_id for r in one.collect()}
    assert {3, 5, 140} <= left and not {100, 101, 141} & left
    assert len({brute_print(r.text) for r in one.collect()}) == one.count()
    cut = {r.doc_id: r for r in stages.suffix_array_dedup(spark, docs, folder).collect()}
    assert {i: r.text.encode() for i, r in cut.items()} == {r[0]: r[4] for r in brute_suffix(rows, 200)}
    assert all(passage not in r.text and r.n_chars == len(r.text) for r in cut.values())
    assert cut[7].text == dict((r[0], r[1]) for r in rows)[7]
    free = stages.benchmark_decontamination(spark, docs, folder)
    assert {r.doc_id for r in free.collect()} == {r[0] for r in rows} - {130}
    mixed = stages.mixing(spark, docs, folder)
    total = sum(len(words_of(r[1])) for r in rows)
    assert sum(r.taken for r in mixed.collect()) == pytest.approx(1.5 * total, rel=0.1)
    for stage in (clean, one, stages.suffix_array_dedup(spark, docs, folder), free):
        assert stage.dtypes == docs.dtypes
    assert mixed.columns[: len(docs.columns)] == docs.columns


def test_all_stages_together(spark, folder):
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert not out.keys() & {100, 101, 110, 111, 130} and len(out) > 30
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "mixing"]
    assert all(0 < r.taken <= 2 * r.size for r in out.values())


def test_stages_of_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder)
        assert found.count() == 0, name
        if name != "mixing":
            assert found.columns == docs.columns


def test_near_dedup_reaches_a_similarity_of_four_fifths(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert 102 not in {r.doc_id for r in stages.simhash_near_dedup(spark, docs, folder).collect()}


def brute_near(rows):
    """The first of each group, by all pairs of five-word shingle sets."""
    sets = {}
    for i, text, *_ in rows:
        words = [w.lower() for w in words_of(text)]
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
    return {i for i, first in group.items() if i == first}


def test_near_dedup_against_all_pairs(spark, folder):
    rng = random.Random(31)
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.choice((12, 60, 150)))] for _ in range(8)]
    texts = [None, "", " \n", "One two", "one  two", "one two three"]
    for words in base:  # from one changed word to many, and a chain of changes
        chain = list(words)
        for changes in (0, 1, 1, 2, 3, 4, 8):
            near = list(words)
            for at in rng.sample(range(len(near)), changes):
                near[at] = "changed"
            chain = [*chain[2:], "more"]
            texts += [" ".join(near), " ".join(chain)]
    rows = [(i, t, "en", "src", 1) for i, t in enumerate(texts)]
    found = stages.simhash_near_dedup(spark, documents(spark, rows), folder)
    assert {r.doc_id for r in found.collect()} == brute_near(rows)


def test_columns_of_clashing_names(spark):
    """Input columns with the stages' own names, null and repeated ids, a very long text."""
    from cases import documents, rows_of, with_clashes
    from pyspark.sql import functions as F

    from eventmill.llm.near_copies import keep_one

    rng = random.Random(21)
    texts = [" ".join(str(rng.randrange(1000)) for _ in range(80)) for _ in range(6)] + [" ".join(str(i) for i in range(200_000))]
    rows = [*rows_of(*texts), (None, texts[1], "en", "s", 1), (2, texts[2], "en", "s", 1), (None, "none like it", "en", "s", 1)]
    docs = with_clashes(documents(spark, rows)).withColumns({c: F.lit(f"own {c}") for c in ("__id", "__text", "row", "source_size", "taken", "node", "root")})
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    found = {(r.doc_id, r.text): r for r in kept.collect()}
    assert sorted(found, key=str) == sorted([*((i, t) for i, t in enumerate(texts)), (None, "none like it")], key=str)
    assert {(r["__id"], r["__text"], r["row"], r["root"]) for r in found.values()} == {("own __id", "own __text", "own row", "own root")}
    mixed = stages.mixing(spark, docs, "")
    assert mixed.columns[-4:] == ["size", "source_size", "target", "taken"] and len(set(mixed.columns)) == len(mixed.columns)
    assert all(r["__id"] == "own __id" and isinstance(r.taken, int) for r in mixed.collect())


def near_group(rng, copies, changes):
    """Copies of one text, each with as many words of its own, so that most are near some others only."""
    base = [f"b{i}" for i in range(200)]
    for n in range(copies):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.choice(changes)):
            words[at] = f"own{n}x{at}"
        yield " ".join(words)


@pytest.mark.parametrize("tile", [1 << 20, 3000])
def test_near_dedup_of_a_group_that_is_not_all_near(spark, tile):
    from eventmill.llm.near_copies import keep_one

    rng = random.Random(5)
    texts = [*near_group(rng, 60, (2, 3, 4, 5, 6)), *(f"no such text {i} " * 4 for i in range(5))]
    rows = [(i, t, "en", "src", 1) for i, t in enumerate(texts)]
    found = {r.doc_id for r in keep_one(documents(spark, rows), tile).collect()}
    assert found == brute_near(rows) and len(found) > 10


def test_tile_links_join_what_all_pairs_join():
    import numpy as np

    from eventmill.llm.near_copies import tile_links
    from eventmill.llm.simhash import majorities, roots

    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
    sets = []
    for _ in range(80):
        own = rng.integers(0, 1 << 63, rng.integers(0, 14), dtype=np.uint64)
        sets.append(np.unique(np.r_[rng.permutation(base)[len(own) :], own]))
    sets += [np.zeros(0, dtype=np.uint64)] * 2
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets).view(np.int64)
    prints, nodes = majorities(values.view(np.uint64), sizes), rng.permutation(len(sets)).astype(np.int64)
    held = [set(s.tolist()) for s in sets]
    for tiles in (np.zeros(len(sets), dtype=np.int64), rng.integers(0, 2, len(sets))):
        one = len(set(tiles.tolist())) == 1
        pairs = [(a, b) for a in range(len(sets)) for b in range(a) if (one or tiles[a] != tiles[b])
                 and 5 * len(held[a] & held[b]) >= 4 * len(held[a] | held[b])]
        u, v = tile_links(nodes, nodes, prints, tiles, values, sizes)
        place = {n: i for i, n in enumerate(nodes.tolist())}
        mine = np.array([(place[a], place[b]) for a, b in zip(u.tolist(), v.tolist())]).reshape(-1, 2)
        assert {tuple(sorted(x, reverse=True)) for x in mine.tolist()} <= set(pairs)
        want = roots(len(sets), *np.array(pairs).T)
        assert (roots(len(sets), *mine.T) == want).all() and len(mine) == len(sets) - len(set(want.tolist()))


def fingerprints_of(sets):
    import numpy as np

    from eventmill.llm.near_copies import NEAR_WORDS, wide_prints

    sizes = np.array([len(s) for s in sets])
    return wide_prints(np.concatenate(sets), sizes, NEAR_WORDS), sizes


def test_tile_links_within_a_later_tile():
    import numpy as np

    from eventmill.llm.near_copies import near_links, tile_links

    sets = [np.random.default_rng(3).integers(0, 1 << 63, 50, dtype=np.uint64)] * 2
    wide, sizes = fingerprints_of(sets)
    nodes, later = np.array([8, 9]), np.array([3, 3])
    values = np.concatenate(sets).view(np.int64)
    assert [x.tolist() for x in tile_links(nodes, nodes, wide[:, 0], later, values, sizes)] == [[8], [9]]
    assert [x.tolist() for x in near_links(nodes, wide, sizes, later)] == [[8], [9]]
    assert not len(tile_links(nodes, nodes, wide[:, 0], np.array([3, 3]), np.arange(100), sizes)[0])


def test_near_links_join_what_all_pairs_join(monkeypatch):
    import numpy as np

    from eventmill.llm import near_copies
    from eventmill.llm.simhash import roots

    rng = np.random.default_rng(17)
    sets = []
    for n in (4, 40, 400):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for _ in range(60):
            own = rng.integers(0, 1 << 63, rng.integers(0, n // 3 + 1), dtype=np.uint64)
            sets.append(np.r_[rng.permutation(base)[len(own) // 2 :], own])
    sets += [np.zeros(0, dtype=np.uint64)] * 2
    wide, sizes = fingerprints_of(sets)
    nodes = rng.permutation(len(sets)).astype(np.int64)
    place = np.argsort(nodes)
    for block, span in ((256, 4096), (7, 11)):
        monkeypatch.setattr(near_copies, "BLOCK", block)
        monkeypatch.setattr(near_copies, "SPAN", span)
        for tiles in (np.full(len(sets), 2), rng.integers(0, 2, len(sets))):
            near = np.bitwise_count(wide[:, None] ^ wide)
            near = (near[:, :, 0] <= near_copies.RADIUS) & (near.sum(axis=2) <= near_copies.NEAR)
            near &= 5 * np.minimum(sizes[:, None], sizes) >= 4 * np.maximum(sizes[:, None], sizes)
            near &= (tiles[:, None] != tiles) | (tiles.min() == tiles.max())
            u, v = (place[x] for x in near_copies.near_links(nodes, wide, sizes, tiles))
            want = roots(len(sets), *np.nonzero(near))
            assert near[u, v].all() and (roots(len(sets), u, v) == want).all()
            assert len(u) == len(sets) - len(set(want.tolist()))


def test_keys_of_simhash_bits_find_what_is_similar():
    import numpy as np

    from eventmill.llm.near_copies import BUCKET, bit_keys, key_layout, wide_prints

    rng = np.random.default_rng(23)
    assert key_layout(0) == key_layout(1000) and key_layout(100 * BUCKET)[1] == 7
    for documents in (1000, 100 * BUCKET):
        keys, bits = key_layout(documents)
        for n, own in ((4, 0), (9, 1), (90, 10)):  # four of five, eight of ten, eighty of a hundred
            sets = []
            for _ in range(300):
                base = rng.integers(0, 1 << 63, n + max(1, own), dtype=np.uint64)
                sets += [base[:n], base[own:]]
            sizes = np.array([len(s) for s in sets])
            cut = bit_keys(wide_prints(np.concatenate(sets), sizes, -(-keys * bits // 64)), keys, bits)
            assert cut.shape == (600, keys) and (cut >> bits == np.arange(keys)).all()
            assert (cut[::2] == cut[1::2]).any(axis=1).all()
            assert (cut[::2] == np.roll(cut[1::2], 1, axis=0)).mean() < 2 / 2**bits


def test_near_dedup_takes_its_candidates_from_simhash(spark, folder, monkeypatch):
    from eventmill.llm import near_copies

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scratch, seen = near_copies.Scratch.store, {}
    monkeypatch.setattr(near_copies.Scratch, "store", lambda self, rows, label: seen.setdefault(label, scratch(self, rows, label)))
    monkeypatch.setattr(near_copies.Scratch, "remove", lambda self, *labels: None)
    near_copies.keep_one(docs, bucket=20).count()
    prints = {r.node: r for r in seen["near-copy-prints"].collect()}
    pairs = seen["near-copy-pairs"].collect()
    assert pairs and all(set(prints[r.u]["keys"]) & set(prints[r.v]["keys"]) for r in pairs)
    for r in pairs:
        words = [[x % (1 << 64) for x in (prints[n].print, *prints[n].more)] for n in (r.u, r.v)]
        assert (words[0][0] ^ words[1][0]).bit_count() <= near_copies.RADIUS
        assert sum((a ^ b).bit_count() for a, b in zip(*words)) <= near_copies.NEAR


@pytest.mark.parametrize("bucket", [6, 25])
def test_near_dedup_of_keys_in_tiles(spark, bucket):
    from eventmill.llm.near_copies import keep_one

    rng = random.Random(6)
    texts = [*near_group(rng, 50, (2, 3, 4, 5, 6)), *(f"no such text {i} " * 4 for i in range(5)), None, "", " "]
    rows = [(i, t, "en", "src", 1) for i, t in enumerate(texts)]
    found = {r.doc_id for r in keep_one(documents(spark, rows), 3000, bucket).collect()}
    assert found == brute_near(rows) and len(found) > 10
