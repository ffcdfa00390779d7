"""Sharding, token files, packing, MinHash and line de-duplication: round trips and brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starforge.llm import linededup, minhash, packing, planes, sharding
from starforge.llm.queries import QUERIES, vocabulary
from starforge.llm import tokens
from starforge.llm.tokens import encoder

SF = "/root/testdata/sf0.01"
ODD = [(5, None), (3, ""), (9, "one two three"), (9, "one two three"), (None, "A\tb\n c"), (7, " \n "),
       (8, "long " * 9000), (2, "é ́x 中文字 <|endoftext|> don't 12345  !!")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn(
        "start", F.lit(1))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def encoded(name, rows, end):
    coder = Tokenizer.from_file(vocabulary(name))
    return [np.array(coder.encode(t or "", add_special_tokens=False).ids + [end], "<u4") for t in rows]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_encode_like_the_whole_text(name, texts):
    rows = list(texts.values())[:200] + [t for _, t in ODD if t] + [
        "a <|endoftext|> b", "x<|ENDOFTEXT|>y", "<|startoftext|>\n z", "a\x1cb !\x1c! c", "\tx  y", "ΑΣ ΑΣ. İ ǅ ß ẞ", "we'll I'M 's\n\n's", " \n", "x y z "]
    coder = encoder(vocabulary(name))
    want = [x[:-1].tobytes() for x in encoded(name, rows, 0)]
    assert [coder.ids(t) for t in rows] == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_plain_texts_are_cut_into_words_at_once(name, monkeypatch):
    rows = ["", " ", "The  cat's hat,\n\n it'LL 'tis ", "x²½1 ªµ×÷ ſƻ ǀȀ'É\n 12345!?", "a <|end b|> c <d",
            "\n" + " ".join(f"w{i}x, é{i}." for i in range(300))]
    monkeypatch.setattr(tokens, "CACHE", 100)
    coder = tokens.Encoder(vocabulary(name))
    assert [coder.ids(t) for t in rows] == [x[:-1].tobytes() for x in encoded(name, rows, 0)]
    assert not coder.known
    mixed = " ".join(f"w{i} ж{i}" for i in range(300))
    assert coder.ids(mixed) == encoded(name, [mixed], 0)[0][:-1].tobytes()
    assert len(coder.known) + len(coder.known_words) <= tokens.CACHE


def test_ring_sharding_of_the_whole_table(spark, texts):
    got = QUERIES["op4_ring_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    sizes = np.bincount([r.shard for r in got], minlength=8)
    assert sizes.max() - sizes.min() <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    points = sharding.ring(8, 64)
    for r in got:
        at = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:8], 16)
        assert r.home == next((s for p, s in points if p >= at), points[0][1])
    # only the rows that a full shard turned away have moved on
    assert sum(r.home != r.shard for r in got) <= np.maximum(np.bincount([r.home for r in got], minlength=8) - 125, 0).sum() + 8


def test_ring_sharding_of_odd_rows(spark, odd):
    for shards in (1, 3, 8):
        got = sharding.shard(odd, shards=shards).collect()
        assert len(got) == len(ODD)
        n = np.bincount([r.shard for r in got], minlength=shards)
        assert n.max() - n.min() <= 1
        assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(shards) for i in range(n[s])]
    assert sharding.shard(odd.limit(0)).count() == 0
    copies = odd.limit(1).select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.lit(500))))
    n = sharding.shard(copies).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert sum(r.n for r in n) == 500 and all(r.m == r.n - 1 for r in n)


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_planes_round_trip(unit):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 65_536, 200_001):
        ids = rng.integers(0, 2**32, n, dtype=np.uint32) if n % 2 else rng.integers(0, 50_000, n).astype("<u4")
        assert (planes.unpack(planes.pack(ids, unit)) == ids).all()


@pytest.mark.parametrize("unit", ["byte", "bit"])
def test_token_files(spark, odd, tmp_dir, unit):
    name = "word_bpe_49k.json"
    planes.write_ids(odd, f"{tmp_dir}/p", vocabulary(name), unit=unit, segment=1000)
    got = sorted(planes.read_ids(spark, f"{tmp_dir}/p").collect(), key=lambda r: r.start)
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (key, _), ids in zip(got, rows, encoded(name, [t for _, t in rows], 2), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (key, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    planes.write_ids(odd.limit(0), f"{tmp_dir}/e", vocabulary(name))
    assert planes.read_ids(spark, f"{tmp_dir}/e").count() == 0


def test_windows_fill_up():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 500):
        sizes = rng.integers(1, 2048, n).tolist()
        found = packing.windows(sizes, 2048)
        assert sorted(i for w in found for i in w) == list(range(n))
        assert max(sum(sizes[i] for i in w) for w in found) <= 2048
        assert len(found) <= max(3, 1.1 * sum(sizes) / 2048 + 1)
    assert packing.windows([], 2048) == [] and len(packing.windows([2000] * 7, 2048)) == 7


@pytest.mark.parametrize("whole", [False, True])
def test_packing_covers_every_id(spark, odd, texts, whole):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if whole else odd
    rows = list(texts.items()) if whole else ODD
    name = "byte_bpe_50k.json"
    got = packing.pack(docs, vocabulary(name), end=1, window=2048).collect()
    ids = {}
    for (key, _), x in zip(rows, encoded(name, [t for _, t in rows], 1)):
        ids.setdefault(key, x)
    pieces, sequences = {}, {}
    for r in got:
        x = ids[r.doc_id]
        assert r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[r.start:r.start + r.length].tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, parts in pieces.items():
        times = sum(k == key for k, _ in rows)
        assert sum(n for _, n in parts) == times * len(ids[key])
        assert sorted(set(parts)) == [(i, min(2048, len(ids[key]) - i)) for i in range(0, len(ids[key]), 2048)]
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert set(pieces) == {k for k, _ in rows}
    if whole:
        assert sum(len(x) for x in ids.values()) > 0.93 * 2048 * len(sequences)
    assert packing.pack(odd.limit(0), vocabulary(name)).count() == 0


def slow_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components(keys, alike):
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    order = sorted(keys)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if alike(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_minhash_of_the_whole_table(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op1_minhash_fingerprints"](spark, SF).collect()}
    assert set(got) == set(texts)
    order = sorted(texts, reverse=True)
    sets = {k: slow_set(t) for k, t in texts.items()}
    error = []
    for k, after in zip(order, order[1:] + order[:1]):
        text, half = texts[k] or "", len(texts[k] or "") // 2
        new = text[:len(text) - half] + (texts[after] or "")[:half]
        r = got[k]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        error.append(r.near_edited - jaccard(sets[k], slow_set(new)))
        error.append(r.near_next - jaccard(sets[k], sets[after]))
    assert np.abs(error).mean() < 0.03 and np.abs(error).max() < 0.25
    want = components(texts, lambda a, b: min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b]))
                      and jaccard(sets[a], sets[b]) >= 0.8)
    assert {k: r.class_id for k, r in got.items()} == want


def test_minhash_of_odd_rows(spark, odd):
    got = minhash.fingerprints(odd).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[5].fingerprint == by[3].fingerprint == by[7].fingerprint == "f" * 960
    assert by[5].class_id == 3 and by[9].class_id == 9 and by[2].near_next < 1
    assert minhash.fingerprints(odd.limit(0)).count() == 0
    one = minhash.fingerprints(odd.where("doc_id = 8")).collect()
    assert one[0].near_next == 1.0


def dense_set(line):
    """The 8 characters from every place of a line; a shorter line is one shingle."""
    return {line[i:i + 8] for i in range(max(1, len(line) - 7))}


def test_lines_match_brute_force(spark, texts):
    """Every link is one of dense shingles, at least 99 in 100 pairs at 0.8 are in one class, and
    the first line of each class stays."""
    keep = sorted(texts)[:400]
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id").isin(keep))
    lines = {(k, i): line for k in keep for i, line in enumerate((texts[k] or "").split("\n")) if line.strip(" \t\r")}
    first = {}
    for place in sorted(lines):
        first.setdefault(lines[place], place)
    sets = {line: dense_set(line) for line in first}
    by_size = sorted(first, key=lambda line: len(sets[line]))
    linked = []
    for i, a in enumerate(by_size):
        for b in by_size[i + 1:]:
            if len(sets[a]) < 0.8 * len(sets[b]):
                break
            if jaccard(sets[a], sets[b]) >= 0.8:
                linked.append((a, b))
    got = {(r.doc_id, r.line_no): ((r.class_doc, r.class_line), r.kept) for r in linededup.line_classes(docs).collect()}
    assert got.keys() == lines.keys()
    found = [got[first[a]][0] == got[first[b]][0] for a, b in linked]
    assert len(linked) >= 40 and np.mean(found) >= 0.99, (len(linked), np.mean(found))
    # classes hold no line that is not reached over links, and equal lines are in one class
    want = components([first[line] for line in first], lambda x, y: False)
    for a, b in linked:
        x, y = want[first[a]], want[first[b]]
        for k in [k for k, v in want.items() if v == max(x, y)]:
            want[k] = min(x, y)
    for place, line in lines.items():
        (head, kept) = got[place]
        assert want[first[lines[head]]] == want[first[line]] and kept == (head == place) and head <= place
        assert got[first[line]][0] == head
    left = {r.doc_id: r.text for r in linededup.keep_first_lines(docs).collect()}
    for k in keep:
        mine = [line for i, line in enumerate((texts[k] or "").split("\n"))
                if (k, i) not in got or got[k, i][1]]
        assert left.get(k, "").strip("\n\t \r") == "\n".join(mine).strip("\n\t \r")


def test_near_copies_of_a_line_form_one_class(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(60)]
    rows = []
    for i in range(80):
        mine = list(words)
        for _ in range(int(rng.integers(0, 3))):
            mine[int(rng.integers(60))] = f"new{i}"
        rows.append((i, " ".join(mine) + f"\nown line {i} of document number {i * 7919}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.line_classes(docs).where("line_no = 0").select("class_doc").distinct().count()
    assert got == 1


def test_lines_of_odd_rows(spark, odd):
    docs = odd.withColumn("n_chars", F.length("text").cast("long"))
    got = linededup.keep_first_lines(docs)
    assert got.columns == docs.columns
    rows = {(r.doc_id, r.text) for r in got.collect()}
    assert {(5, None), (3, ""), (7, " \n "), (9, "one two three"), (None, "A\tb\n c")} <= rows
    assert linededup.line_classes(odd.limit(0)).count() == 0 and linededup.keep_first_lines(odd.limit(0)).count() == 0


def test_lines_are_compared_at_every_character(spark, texts):
    unlike = ["user_id=123456", "user_id=987654", "2024-01-15T10:00:00", "2024-01-99T23:59:59",
              "Andththwhes.", "Andththwhwh.", "中文字符没有空格的一行文字甲乙丙丁", "中文字符没有空格的另外几个词语戊己"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(unlike)], "doc_id long, text string")
    assert linededup.line_classes(docs).where("kept").count() == len(unlike)
    assert {r.doc_id: r.text for r in linededup.keep_first_lines(docs).collect()} == dict(enumerate(unlike))
    keep = sorted(texts)[:400]                    # links are those of dense shingles, in real lines too
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id").isin(keep))
    by_id = {r.line_id: r.line for r in linededup.lines(docs).collect()}
    pairs = [(a, b) for c in linededup.line_components(docs).groupBy("component").agg(
        F.collect_list("node").alias("n")).collect() for a in c.n for b in c.n if a < b]
    assert pairs and all(any(jaccard(dense_set(by_id[a]), dense_set(by_id[x])) >= 0.8
                             for x in {p for q in pairs if a in q for p in q} - {a}) for a, _ in pairs)


def test_shifted_lines_without_spaces_are_one_class(spark):
    rng = np.random.default_rng(5)
    runs = ["".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 3000, n)) for n in (59, 100, 400)]
    runs += ["https://example.org/" + "".join(rng.choice(list("abcdef0123456789/"), n)) for n in (60, 300)]
    rows = [t for run in runs for t in (run, "x" + run, run[:30] + "y" + run[30:])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.class_doc for r in linededup.line_classes(docs).collect()}
    # 52 and 53 shingles, 45 in common: the first run and its copy with a character inside are 0.75 alike
    assert got == {i: i - i % 3 for i in range(len(rows))} | {2: 2}


def test_pipeline(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, docs, SF)
        assert after.columns == docs.columns, name
        rows = {r.doc_id: r.text for r in after.collect()}
        before = {r.doc_id: r.text for r in docs.collect()}
        assert rows.keys() <= before.keys() and len(rows) > 0.7 * len(before), name
        if name != "line_dedup":
            assert all(before[k] == t for k, t in rows.items()), name
        docs = spark.createDataFrame(after.collect(), after.schema)
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
