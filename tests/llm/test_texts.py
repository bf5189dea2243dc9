"""Operators on texts against brute force, with every odd case in one table."""

from __future__ import annotations

import hashlib
import random
import zlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitval.llm import decontaminate, pieces, quality_lines, sharding, simhash, suffixes, token_counts
from tests.llm.conftest import sentence


def removed(rows, length=100):
    """(doc_id, bytes, removed, spans, hash) of each row, repeats found string by string."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        own = (rows[i][1] or "").encode()
        gone = bytearray(len(own))
        for p in range(len(own) - length + 1):
            if own[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(own[p : p + length])
        kept = bytes(b for b, g in zip(own, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((rows[i][0], len(own), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found_repeats(docs):
    kept, names = suffixes.RepeatFinder(docs).kept()
    rows = kept.select("doc_id", *names).collect()
    return sorted(((r[0], r[1], r[2], r[3], hashlib.sha256(r[4]).hexdigest()) for r in rows), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_repeats(make_docs, odd_rows, monkeypatch, small):
    if small:
        monkeypatch.setattr(suffixes, "CHUNK_BYTES", 5_000)
        monkeypatch.setattr(suffixes, "BUCKET_BYTES", 5_000)
        monkeypatch.setattr(suffixes, "BLOCK", 1_000)
    assert found_repeats(make_docs(odd_rows)) == removed(odd_rows)


@pytest.mark.parametrize("ranges", [1, 3])
def test_repeats_with_more_buckets_than_ranges(make_docs, odd_rows, monkeypatch, ranges):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 5_000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(suffixes, "MOST_RANGES", ranges)
    finder = suffixes.RepeatFinder(make_docs(odd_rows))
    assert finder.ranges == ranges and finder.buckets > 20
    assert found_repeats(make_docs(odd_rows)) == removed(odd_rows)


def test_repeats_with_every_lead_frequent(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 5_000)

    def all_hot(self):
        texts = [(t or "").encode() for _, t in odd_rows]
        data = np.frombuffer(b"".join(texts) + bytes(8), np.uint8)
        return np.zeros(0, np.uint64), np.unique(suffixes.unaligned_words(data).byteswap())

    monkeypatch.setattr(suffixes.RepeatFinder, "splitters", all_hot)
    assert found_repeats(make_docs(odd_rows)) == removed(odd_rows)


def test_multikey_quicksort_sorts():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (20_000, 4)).astype(np.uint64)
    assert (words[suffixes.multikey_quicksort(words)] == np.array(sorted(map(tuple, words.tolist())))).all()


def test_cut_text_stays_text(make_docs):
    """A repeat that begins or ends inside a character leaves no broken character behind."""
    passage = "".join(map(chr, range(0x4E00, 0x4E28)))  # 40 characters of three bytes
    # "é" is C3 A9 and "ã" C3 A3: the repeat of the second text begins and ends inside such a character.
    docs = make_docs([(1, "1é" + passage + "é"), (2, "2ã" + passage + "ã"), (3, "3" + passage)])
    rows = {r["doc_id"]: r["text"] for r in suffixes.remove_repeats(docs).collect()}
    assert rows == {1: "1é" + passage + "é", 2: "2\u00e3" if "\u00e3" in rows[2] else "2", 3: "3"}
    assert "\ufffd" not in "".join(rows.values())


def component_ids(rows):
    def words(t):
        return [w for w in re.split("[ \t\n\v\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]

    prints = []
    for _, text in rows:
        w = words(text)
        shingles = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min([x for x in (i, least.get(r)) if x is not None], default=None)
    return sorted(((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, root, strict=True)), key=repr)


def test_near_copies(make_docs, odd_rows):
    got = sorted((tuple(r) for r in simhash.near_copies(make_docs(odd_rows)).collect()), key=repr)
    assert got == component_ids(odd_rows)


def test_links_at_every_distance(spark, monkeypatch):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for p in list(prints)[:150]:
        flips = rng.sample(range(64), rng.randint(1, 6))
        prints.add(p ^ sum(1 << b for b in flips))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    nodes = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    assert {tuple(r) for r in simhash.links(nodes).collect()} == want
    monkeypatch.setattr(simhash, "THREE_SEGMENTS_UP_TO", 0)
    assert {tuple(r) for r in simhash.links(nodes).collect()} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    assert {r["node"]: r["root"] for r in simhash.components(edges).collect()} == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_keep_one(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = [r["doc_id"] for r in simhash.keep_one(docs).select("doc_id").collect()]
    assert sorted(kept, key=repr) == sorted({i for i, _, c in component_ids(odd_rows) if i == c}, key=repr)


def windows(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(rows, items):
    out = []
    for i, text in rows:
        w = windows(text)
        hit, found = set(), set()
        for item, own in items:
            v = windows(own)
            n = min(13, len(v))
            if not n or item is None:
                continue
            wanted = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wanted:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("short,slots", [(False, None), (True, None), (True, 7)])
def test_contamination(spark, make_docs, odd_rows, monkeypatch, short, slots):
    """Also where the filter is full and lets every fingerprint through."""
    if slots:
        monkeypatch.setattr(decontaminate, "FILTER_SLOTS", slots)
    by_id = dict(odd_rows)
    items = [(1, by_id[10][200:700]), (2, by_id[10][200:700].upper()), (10, by_id[5][:90]), (3, None), (4, "  -- "), (5, sentence(random.Random(9), 50))]
    if short:
        items += [(6, "same words come again"), (7, "abc def"), (8, " ".join(by_id[22].split()[50:58])), (9, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.hits(make_docs(odd_rows), bench).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=repr) == contaminated(odd_rows, items)
    kept = decontaminate.drop_contaminated(make_docs(odd_rows), bench).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted((r[0] for r in contaminated(odd_rows, items) if not r[5]), key=repr)


def test_winnowing(spark):
    rng = random.Random(3)
    lists = [[rng.randint(-50, 50) for _ in range(n)] for n in (0, 1, 8, 9, 10, 40)]
    got = spark.createDataFrame([(h,) for h in lists], "h array<bigint>").select(decontaminate.winnowed(F.col("h"))).collect()
    assert [set(r[0]) for r in got] == [{min(h[i : i + 9]) for i in range(len(h) - 8)} for h in lists]


def test_short_items_leave_winnowing_on(spark):
    """A document of unlike words offers few fingerprints, with a short item in the benchmark or without."""
    text = " ".join(f"w{i}" for i in range(400))
    items = [(1, " ".join(f"w{i}" for i in range(100, 300)))]
    sizes = []
    for more in ([], [(2, "some other short item here now")]):
        bench = decontaminate.Benchmark(spark.createDataFrame(items + more, "item_id long, text string"))
        offered = spark.createDataFrame([(text,)], "text string").select(bench.offered(decontaminate.words(F.col("text"))).alias("o"))
        prints = set(offered.first()["o"])
        own = {r["print"] for r in bench.prints.collect()}
        sizes.append(len(prints & own))
        assert len(prints - own) < 5
    assert sizes[0] == sizes[1] < 80


def base_figures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    times = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    again = {p for k in range(len(w) - 4) if times[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        repeats += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(again)


def test_quality_figures(make_docs, odd_rows):
    got = quality_lines.judge(make_docs(odd_rows), None).collect()
    want = [(i, *base_figures(t)) for i, t in odd_rows]
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])


def test_quality_learns_lines(spark, make_docs):
    rng = random.Random(4)
    good = [(i, "\n".join(sentence(rng, 15) for _ in range(6))) for i in range(60)]
    bad = [(i, sentence(rng, 15) + "\n" + "\n".join(" | ".join(sentence(rng, 12).upper().split()) + " ***" for _ in range(8))) for i in range(60, 120)]
    docs = make_docs(good + bad + [(500, None)])
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    field = quality_lines.train(docs, labels)
    kept = {r["doc_id"] for r in quality_lines.judge(docs, field).where("kept").collect()}
    assert kept == set(range(60))
    assert {r["doc_id"] for r in quality_lines.keep_good(docs, labels).collect()} == kept
    assert quality_lines.train(docs, labels.where("quality = 1")) is None


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(7)
    field = quality_lines.Field(rng.normal(size=(3, 2)), rng.normal(size=2), rng.normal(size=(2, 2)))
    for size in (1, 2, 7):
        features = rng.normal(size=(size, 3))
        score = features @ field.emission

        def total(path, score=score):
            return field.start[path[0]] + sum(score[k, x] for k, x in enumerate(path)) + sum(field.step[a, b] for a, b in zip(path, path[1:], strict=False))

        paths = [[n >> k & 1 for k in range(size)] for n in range(2**size)]
        assert field.decode(features, [size]).astype(int).tolist() == max(paths, key=total)


def test_pieces_equal_the_library(spark, make_docs, odd_rows):
    from sentencepiece import SentencePieceProcessor

    path = pieces.tokenizer_path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    rows = odd_rows + [(50, " a  b "), (51, "▁x ▁"), (52, "<s> </s> <0x0A>\n\n"), (53, "\x00a")]
    docs = make_docs(rows)
    got = pieces.encode(docs, path).select("doc_id", "ids", "text").collect()
    assert pieces.encode(docs, path).columns == [c for c in docs.columns if c != "ids"] + ["ids"]
    for r in got:
        assert r["ids"] == (None if r["text"] is None else library.encode(r["text"]))
    back = pieces.decode(pieces.encode(docs, path).select("text", "ids"), path).collect()
    assert all(r["decoded"] == (r["text"] and r["text"].replace("▁", " ") if r["text"] is not None else None) for r in back)


def test_unigram_paths_have_the_best_sum():
    scores = {"▁": -4.0, "a": -2.0, "b": -2.0, "ab": -3.0, "▁a": -3.5, "ba": -2.5, "bab": -3.2, "▁ab": -5.0}
    model = pieces.PieceModel(scores, {p: i for i, p in enumerate(scores)}, list(range(100, 356)), pieces.UNIGRAM)
    text = {i: p for p, i in model.ids.items()}

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:k]] + best(word[k:]) for k in range(1, len(word) + 1) if word[:k] in scores)

    for word, ids in model.encode_words({"abab", "ab", "abba", "bab", "babab", ""}).items():
        assert "".join(text[i] for i in ids) == "▁" + word
        assert sum(scores[text[i]] for i in ids) == pytest.approx(best("▁" + word))


def test_token_counts_equal_the_library(make_docs, odd_rows):
    from tokenizers import Tokenizer

    path = pieces.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = odd_rows + [(60, "<|endoftext|>A<|startoftext|> <|ENDOFTEXT|>"), (61, "J\u030c ΣΑΣ İI'M it's 9漢字각 🙂☃'ll ſK")]
    got = token_counts.count_tokens(make_docs(rows), path).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_shards(make_docs, odd_rows):
    rng = random.Random(8)
    rows = odd_rows + [(i, sentence(rng, rng.randint(1, 60))) for i in range(100, 400)]
    got = sharding.place(make_docs(rows), shards=4).collect()
    assert len(got) == len(rows)
    places = {}
    for r in got:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(4))
    assert sorted((r["doc_id"], r["size"]) for r in got if r["doc_id"] is not None) == sorted((i, len((t or "").encode()) + 1) for i, t in rows if i is not None)


def test_rebalancing_moves_only_what_it_must():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 1000, 4096)
    first = sharding.first_map()
    again = sharding.rebalanced(first, sizes, 16)
    load = np.bincount(again, weights=sizes, minlength=16)
    assert load.max() - load.min() <= sharding.CLOSE * load.mean()
    assert (first != again).sum() < 400
    assert (sharding.rebalanced(again, sizes, 16) == again).all()
    grown = sharding.rebalanced(again, sizes, 17)
    assert np.bincount(grown, weights=sizes, minlength=17).min() > 0.99 * sizes.sum() / 17


def test_slot_maps_keep_versions(spark, tmp_path):
    maps = sharding.SlotMaps(spark, str(tmp_path / "maps"))
    maps.save(0, sharding.first_map(64, 4))
    maps.save(1, sharding.first_map(64, 5))
    assert (maps.load(0) == sharding.first_map(64, 4)).all() and (maps.load(1) == sharding.first_map(64, 5)).all()
    with pytest.raises(Exception, match="exists"):
        maps.save(1, sharding.first_map(64, 4))


def test_empty_tables(spark, make_docs):
    docs = make_docs([(1, "x")]).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = pieces.tokenizer_path("piece_bpe_32k.model")
    for made in (
        simhash.near_copies(docs), simhash.keep_one(docs), suffixes.remove_repeats(docs), decontaminate.hits(docs, bench),
        quality_lines.keep_good(docs, labels), quality_lines.judge(docs, None), pieces.encode(docs, path), sharding.place(docs),
        token_counts.count_tokens(docs, pieces.tokenizer_path("word_bpe_49k.json")),
    ):
        assert made.count() == 0
    some = make_docs([(1, "a b c")])
    assert decontaminate.hits(some, bench).first()["contaminated"] is False


def test_a_stored_map_is_edited(spark, tmp_path, make_docs):
    """Bytes are near equal, and later calls move slots of the newest map only where they must."""
    rng = random.Random(71)
    rows = [(i, sentence(rng, rng.randint(1, 60))) for i in range(600)] + [(None, "no id"), (900, None), (901, "x" * 40_000)]
    maps = sharding.SlotMaps(spark, str(tmp_path / "own"))

    def placed(rows, shards):
        got = sharding.place(make_docs(rows), shards, slots=256, maps=maps).collect()
        assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in got if r["doc_id"] is not None) == sorted(
            (i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode()), "bytes") for i, t in rows if i is not None
        )
        load = np.zeros(shards, int)
        for r in got:
            load[r["shard"]] += r["size"]
        for shard in range(shards):
            own = sorted(r["slot"] for r in got if r["shard"] == shard)
            assert own == list(range(len(own)))
        return load, {r["virtual_slot"]: r["shard"] for r in got}

    load, first = placed(rows[:-1], 4)
    assert load.max() - load.min() <= 0.01 * load.mean() and maps.versions() == [0, 1]
    assert placed(rows[:-1], 4)[1] == first and maps.versions() == [0, 1]
    load, more = placed(rows[:-1], 5)
    assert load.max() - load.min() <= 0.02 * load.mean() and maps.versions() == [0, 1, 2]
    # Some fifth of the slots goes to the new shard; few others move.
    assert sum(first[s] == more[s] for s in first) > 0.6 * len(first)
    load, _ = placed(rows, 5)
    # One record is more than a shard's share: its shard holds little else.
    assert load.max() < 40_001 + 2_000
    with pytest.raises(ValueError, match="slots"):
        sharding.place(make_docs(rows), 5, slots=128, maps=maps)


def test_token_counts_by_small_chunks_and_buckets(make_docs, odd_rows, monkeypatch):
    """Chunks of few texts and many buckets give the same counts; long texts the same pre-tokens."""
    from tokenizers import Tokenizer

    path = pieces.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(token_counts, "BUCKET_BYTES", 64)
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", 1000)
    rows = odd_rows + [(60, "<|endoftext|>"), (60, "<|endoftext|>" * 3 + " a"), (61, "a\0b\0" * 400)]
    got = token_counts.count_tokens(make_docs(rows).coalesce(2), path).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    own = token_counts.Counter(path)
    whole = [list(own.pretokens(t or "")) for _, t in rows]
    monkeypatch.setattr(token_counts, "PIECE_BYTES", 5)
    assert [list(own.pretokens(t or "")) for _, t in rows] == whole
