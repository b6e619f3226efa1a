"""SimHash groups, decontamination, WARC archives, rules and the mix, against brute force."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from cases import documents, odd_texts, rows_of, with_clashes, words_of

from eventmill.llm import simhash, warc
from eventmill.llm.components import connected
from eventmill.llm.decontaminate import contaminated, decontaminate
from eventmill.llm.mixing import mix, targets
from eventmill.llm.quality_rules import quality_rules, text_counts

ODD = rows_of(*odd_texts())
PAGES = "page_id long, url string, html string"


# SimHash


def brute_print(text, size=4):
    words = [w.lower() for w in words_of(text)]
    shingles = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints: dict[int, int], radius=4) -> dict[int, int]:
    group = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return group


def test_simhash_is_exact(spark):
    prints = {r[0]: brute_print(r[1]) for r in ODD}
    groups = brute_groups(prints)
    found = simhash.near_duplicates(with_clashes(documents(spark, ODD))).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {d: (f"{p:016x}", groups[d]) for d, p in prints.items()}
    assert prints[0] == prints[1] == 0 and groups[1] == 0


def test_fingerprints_of_many_shingles():
    hashes = np.random.default_rng(0).integers(0, 1 << 63, 3000, dtype=np.uint64)
    sizes = np.array([0, 1, 254, 255, 256, 2, 0, 1500, 732])
    found, at = simhash.majorities(hashes, sizes), 0
    for size, print_ in zip(sizes, found):
        part = hashes[at : at + size].tolist()
        at += size
        assert int(print_) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > size)


def test_links_join_all_that_is_near_across_tiles(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    nodes = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (1 << 64) - 1 for b in base for _ in range(30)} | set(base)
    frame = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in nodes], "fingerprint long")
    for tile in (16, 512):
        links = simhash.links(frame, tile=tile)
        group = {n: n for n in nodes}
        for u, v in connected(links).collect():
            group[u % (1 << 64)] = v % (1 << 64)
        want = brute_groups(dict(zip(nodes, nodes)))
        assert len(set(group.values())) == len(set(want.values()))
        assert len({(group[n], want[n]) for n in nodes}) == len(set(want.values()))


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(3)
    names = rng.sample(range(-(10**12), 10**12), 400)
    chain = list(zip(names[:99], names[1:100]))
    hub = [(names[100], n) for n in names[101:250]]
    loops = [(names[300], names[300]), (names[301], names[302]), (names[302], names[301])]
    found = dict(map(tuple, connected(spark.createDataFrame(chain + hub + loops, "u long, v long")).collect()))
    for part in (names[:100], names[100:250], names[301:303]):
        assert {found.get(n, n) for n in part} == {min(part)}
    assert names[300] not in found
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_simhash_keeps_one_of_each_group(spark):
    text = odd_texts()[6]
    rows = [*ODD, (6, text, "en", "s", 5), (None, text, None, None, None), (None, "alone in the world", None, None, None)]
    kept = simhash.keep_one(with_clashes(documents(spark, rows)))
    ids = [r.doc_id for r in kept.collect()]
    groups = brute_groups({r[0]: brute_print(r[1]) for r in ODD})
    assert sorted(i for i in ids if i is not None) == sorted(set(groups.values()))
    assert ids.count(None) == 1 and kept.columns == with_clashes(documents(spark, rows)).columns
    assert simhash.keep_one(documents(spark, [])).count() == 0
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


# Decontamination


def brute_contamination(rows, items):
    def shingles(words):
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []

    items = [(i, [w.lower() for w in words_of(t)]) for i, t in items]
    items = [(i, w) for i, w in items if w]
    having = Counter(s for _, w in items for s in set(shingles(w)))

    def weight(s):
        return 1 + math.log(len(items) / having[s]) if s in having else 1 + math.log(len(items))

    out = {}
    for doc_id, text, *_ in rows:
        words = [w.lower() for w in words_of(text)]
        for item_id, item in items:
            a, best = Counter(shingles(item)), (0.0, 0)
            for start in range(max(1, len(words) - len(item) + 1)):
                window = words[start : start + len(item)]
                # A shorter item is one shingle, and so is each window of its size.
                b = Counter(shingles(window)) if len(window) >= min(5, len(item)) else Counter()
                both = sum(weight(s) * min(a[s], b[s]) for s in a)
                every = sum(weight(s) * max(a[s], b[s]) for s in set(a) | set(b))
                best = max(best, (round(both / every, 9), -start))
            if best[0] >= 0.8:
                out[doc_id, item_id] = (-best[1], min(len(item), len(words)), best[0])
    return out


def leaks():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([40, 25, 60, 3, 1, 30, 30])]
    items += [(7, None), (8, ""), (9, items[0][1])]
    changed = items[2][1].split()
    changed[30] = "changed"
    shorter = items[5][1].split()
    del shorter[3]
    texts = [
        " ".join(rng.choices(vocabulary, k=80)) + "\n" + items[0][1].upper() + " tail", " ".join(changed), items[5][1],
        "x " * 30 + " ".join(shorter) + " y" * 30, None, "", items[3][1], "a " + items[4][1] + " b", " ".join(items[1][1].split()[:24]),
        " ".join(rng.choices(vocabulary, k=500)), items[6][1] + " " + items[6][1]]
    return rows_of(*texts), items


def test_contamination_is_exact(spark):
    rows, items = leaks()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = with_clashes(documents(spark, rows))
    found = {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity) for r in contaminated(docs, with_clashes(benchmark)).collect()}
    assert found == brute_contamination(rows, items)
    assert {d for d, _ in found} >= {0, 1, 2, 6}
    clean = decontaminate(docs, benchmark)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {d for d, _ in found} and clean.columns == docs.columns


def test_contamination_by_slices_of_the_benchmark(spark, monkeypatch):
    from eventmill.llm import decontaminate as module

    rows, items = leaks()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    parts = module.indexes(benchmark, slice_of=3)
    assert len(parts) > 1
    monkeypatch.setattr(module, "indexes", lambda *_: parts)
    found = {(r.doc_id, r.item_id) for r in contaminated(documents(spark, rows), benchmark).collect()}
    assert found == set(brute_contamination(rows, items))


def test_contamination_of_empty_tables(spark):
    rows, items = leaks()
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(documents(spark, rows), none).count() == 0
    assert decontaminate(documents(spark, rows), none).count() == len(rows)
    assert contaminated(documents(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0


# WARC


def pages():
    long = "<p>" + "é text " * 30_000
    rows = [(i, f"https://Host{i % 4}.Example.com:443/p/{i}?q={i}#f", f"<html>{i % 7}</html>") for i in range(60)]
    return rows + [
        (100, None, None), (101, "", ""), (102, "http://[bad", "x"), (103, "https://a.b/\nspaced url", "x"), (104, "https://a.b/", long),
        (105, "https://a.b/", long), (None, "https://none/", "x"), (None, "https://none/", "alone"), (3, "https://again/", "<html>3</html>"),
        (104, "https://a.b/", long)]


def brute_pages(rows):
    holder: dict[str, tuple] = {}
    for page_id, _, html in rows:
        holder[html or ""] = max(holder.get(html or "", (False, 0)), (page_id is not None, page_id or 0))
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        whole = holder[html or ""] == (page_id is not None, page_id or 0)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), digest, "response" if whole else "revisit", None if whole else holder[html or ""][1], payload if whole else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("lines", [1, 3, 1000])
def test_archives_are_read_back_whole(spark, tmp_path, lines, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    monkeypatch.setattr(warc.write_index, "__defaults__", (lines,))
    rows = pages()
    frame = with_clashes(spark.createDataFrame(rows, PAGES).repartition(3))
    read = warc.round_trip(spark, frame, str(tmp_path / "warc")).collect()
    assert sorted(((*r[:5], bytes(r.payload) if r.payload is not None else None) for r in read), key=str) == brute_pages(rows)
    # Any WARC reader finds whole records: members of gzip, header, block, two line ends.
    members = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "warc/archives").iterdir())
    assert members.count(b"WARC/1.1\r\n") == len(rows)


def test_pages_that_were_not_captured_are_not_found(spark, tmp_path):
    rows = pages()
    shards = warc.archive(spark.createDataFrame(rows, PAGES), str(tmp_path / "warc"))
    wanted = spark.createDataFrame([(5, rows[5][1]), (6, "https://elsewhere/"), (None, None), (999, rows[5][1])], "page_id long, url string")
    assert [r.page_id for r in warc.read_pages(wanted, shards, str(tmp_path / "warc")).collect()] == [5]
    empty = spark.createDataFrame([], PAGES)
    assert warc.round_trip(spark, empty, str(tmp_path / "none")).count() == 0


def test_small_payloads_need_no_revisit(spark, tmp_path):
    rows = [(1, "https://a/", "same"), (2, "https://b/", "same"), (3, "https://c/", "same and long"), (4, "https://d/", "same and long")]
    read = warc.round_trip(spark, spark.createDataFrame(rows, PAGES), str(tmp_path / "warc"), least=10)
    assert {r.page_id: r.record_type for r in read.collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_capture_keys():
    assert warc.capture_key("https://www.Example.com:443/A?b=1#c") == "com,example,www)/A?b=1"
    assert warc.capture_key("http://example.com:8080") == "com,example:8080)/"
    assert warc.capture_key("not a url") == "not a url" and warc.capture_key(None) == ""


def test_a_damaged_record_is_noticed():
    member = warc.write_record(1, "https://a/", b"payload", None)
    raw = gzip.decompress(member).replace(b"payload", b"payl0ad")
    with pytest.raises(ValueError):
        warc.read_record(gzip.compress(raw))


# Rules


def brute_counts(text):
    text = text or ""
    words = words_of(text)
    where = defaultdict(list)
    for i in range(len(words) - 4):
        where[tuple(words[i : i + 5])].append(i)
    repeated = {i + j for places in where.values() if len(places) > 1 for i in places for j in range(5)}
    lines = [line for line in text.split("\n") if words_of(line)]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


def test_rules_are_exact(spark):
    texts = [*odd_texts(), "a b c d e a b c d e", "x|y <z> #1 & 100% $$ **", "l1 x\n\nl1 x\n \n l1 x\nl1 x", "p q r s t u v w x y z"]
    rows = rows_of(*texts)
    counted = text_counts(with_clashes(documents(spark, rows)))
    found = {r.doc_id: tuple(r[2:]) for r in counted.select("doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
    assert found == {r[0]: brute_counts(r[1]) for r in rows}
    judged = quality_rules(documents(spark, rows)).collect()
    for r in judged:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.host_rate <= 0.5)


def test_a_host_that_fails_takes_its_good_documents_along(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good if i % 10 == 0 else "short", "en", "bad", 1) for i in range(100)]
    rows += [(1000 + i, good, "en", f"host{i % 8}", 1) for i in range(400)]
    rows += [(2000, "short", "en", "tiny", 1), (2001, good, "en", "tiny", 1), (2002, good, "en", None, 1)]
    judged = {r.doc_id: r for r in quality_rules(documents(spark, rows)).collect()}
    assert len(judged) == len(rows)
    assert not judged[0].base_failed and not judged[0].kept and judged[0].host_rate > 0.5
    assert judged[1000].kept and judged[2002].kept
    assert 0 < judged[2001].host_rate < 0.5 and judged[2001].kept  # one failure of two is little evidence
    assert quality_rules(documents(spark, [])).count() == 0


# Mixing


def brute_targets(sizes: dict, total=1.5, epochs=2):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = total * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > epochs * sizes[s]}
        if not over:
            out.update((s, level * weight[s]) for s in open_)
            break
        for s in over:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def mixed_rows():
    rng = random.Random(2)
    sources = ["a", "b", "é", "Z", None, "c", "d"]
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), "en", rng.choices(sources, [30, 5, 10, 3, 8, 1, 1])[0], 1) for i in range(600)]
    return rows + [(None, "no id", "en", "a", 1), (5, "again", "en", "a", 1), (601, None, "en", "empty", None)]


def test_targets_are_those_of_repeated_resharing(spark):
    sizes = defaultdict(int)
    for _, text, _, source, _ in mixed_rows():
        sizes[source] += len(words_of(text))
    mixed = mix(with_clashes(documents(spark, mixed_rows()))).collect()
    want = brute_targets(dict(sizes))
    assert {r.source: r.source_size for r in mixed} == dict(sizes)
    for r in mixed:
        assert r.target == pytest.approx(want[r.source])


def test_taken_words_come_near_the_targets(spark):
    mixed = mix(documents(spark, mixed_rows())).collect()
    assert len(mixed) == len(mixed_rows())
    taken, target = defaultdict(int), {}
    for r in mixed:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)  # at most the longest document
    again = mix(documents(spark, mixed_rows(), parts=7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))


def test_mix_of_odd_tables(spark):
    assert mix(documents(spark, [])).count() == 0
    nothing = mix(documents(spark, rows_of(None, "", " "))).collect()
    assert [(r.taken, r.target) for r in nothing] == [(0, 0.0)] * 3
    assert mix(documents(spark, rows_of("just one here"))).first().taken in (3, 6)
    sizes = spark.createDataFrame([("a" + "x", 10), ("ay", 0)], "source_key string, size long")
    assert {r.source_key: r.target for r in targets(sizes).collect()} == {"ax": 15.0, "ay": 0.0}
