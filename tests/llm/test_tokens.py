import random
import zlib

import numpy as np
import pytest

from mobility.llm import edit_counts, packing, tokenfile, tokens
from mobility.llm.common import keyed
from tests.llm.brute import EDGE_TEXTS, SHORT_TEXTS, documents, edge_docs, empty_docs


@pytest.fixture(scope="module")
def encode():
    return tokens.Encoder(tokens.vocabulary())


def plain(encode, text):
    return encode.tokenizer.encode(text or "", add_special_tokens=False).ids


PARTS = [" ", "  ", "\n", "\t", "a", "b'", "é", "'s", "1", "#", " the", "日本", "\x1c", "\x85", " ", "<|endoftext|>", ".", "word ",
         "\n\n", "—", "½", "٣", "\u0301", "'", '"', "©", "×", "ō", "ª", "\r\n", "\u3000", "▁", "<s>", "12", "e.", "!)", "The"]


def test_chunks_encode_like_the_tokenizer(encode):
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert "".join(encode.chunks(text)) == text
        assert np.frombuffer(encode.encoded([text])[0], tokens.ID).tolist() == plain(encode, text)


def test_added_tokens_encode_like_a_fresh_tokenizer(encode):
    fresh = tokens.Tokenizer.from_file(tokens.vocabulary())
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice([*PARTS, "<|endoftext|>", "  <|endoftext|>"]) for _ in range(rng.randint(1, 14)))
        ids = fresh.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode.encoded([text, "plain text"])[0], tokens.ID).tolist() == ids
    assert fresh.encode("a<|endoftext|>", add_special_tokens=False).ids[-1] == 50256
    text = " ".join(f"word{i}" for i in range(200))
    tree = edit_counts.CountTree(text, encode)
    for a, b, new in ((700, 700, "  <|endoftext|> "), (0, 0, "x  "), (702, 707, ""), (50, 60, " y"), (90, 90, "<|endoftext|>")):
        tree.replace(a, b, new)
        text = text[:a] + new + text[b:]
        assert (tree.text(), tree.n_tokens) == (text, len(fresh.encode(text, add_special_tokens=False).ids))


def test_plain_added_tokens_are_text():
    fresh = tokens.Tokenizer.from_file(tokens.vocabulary())
    fresh.encode_special_tokens = True
    encode = tokens.Encoder(tokens.vocabulary(), plain=True)
    rng = random.Random(7)
    for _ in range(500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encode.encoded([text])[0], tokens.ID).tolist() == fresh.encode(text, add_special_tokens=False).ids


def test_pieces_are_those_of_the_library():
    pieces = tokens.PieceEncoder(tokens.vocabulary("piece_bpe_32k.model"))
    assert pieces.cuts
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14)))
        got = np.frombuffer(pieces.encoded([" " + text])[0], tokens.ID).tolist()
        if text and "▁" not in text:
            assert got == pieces.processor.encode(text), text
        assert "".join(pieces.chunks(" " + text)) == " " + text
    for piece in ("a ", "a.", "1a", ".a", "\n", "a1"):
        assert tokens._spans_a_cut(piece)
    for piece in (" the", "  ", ").", "été", "aж", "'s"):
        assert not tokens._spans_a_cut(piece)


def test_full_cache_changes_nothing(encode):
    small = tokens.Encoder(tokens.vocabulary(), cache_bytes=2000)
    texts = [f"word{i} other{i % 7} and\nmore{i}" for i in range(60)] + ["x" * 5000]
    assert small.encoded(texts) == encode.encoded(texts)
    assert [small.encoded([t])[0] for t in texts] == encode.encoded(texts)


def _check_tokenfile(spark, docs, encode):
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = sorted(tokenfile.query(spark, docs).collect(), key=lambda r: r.start)
    start = 0
    for r, g in zip(rows, got, strict=True):
        ids = np.array(plain(encode, r.text) + [2], "<u4")
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_file_round_trip(spark, encode):
    _check_tokenfile(spark, documents(spark), encode)
    _check_tokenfile(spark, edge_docs(spark), encode)
    assert tokenfile.query(spark, empty_docs(spark)).collect() == []


def test_shared_folder_is_a_full_uri(spark, tmp_path):
    from types import SimpleNamespace

    from mobility.llm.common import shared_dir

    def session(setting, master="local[2]"):
        context = SimpleNamespace(getConf=lambda: {"spark.checkpoint.dir": setting}, master=master)
        unset = SimpleNamespace(get=lambda key, default=None: default)
        return SimpleNamespace(sparkContext=context, conf=unset, _jvm=spark._jvm, _jsc=spark._jsc)

    assert shared_dir(session(str(tmp_path))).startswith(f"file://{tmp_path}/llm-")
    assert shared_dir(session("hdfs://store/x/")).startswith("hdfs://store/x/llm-")
    assert shared_dir(session(None)).startswith("file:///")
    with pytest.raises(ValueError):
        shared_dir(session(None, "yarn"))


def test_lost_shards_and_run_folders_are_removed(spark, tmp_path):
    import os

    from mobility.llm.common import run_folder

    folder = f"file://{tmp_path}/shards"
    lost = tokenfile.ShardWriter(folder)
    lost.add(1, np.arange(5))
    lost.close()
    open(f"{tmp_path}/shards/half.tok.zst.part", "w").close()
    manifest = tokenfile.write_shards(keyed(edge_docs(spark, SHORT_TEXTS)), folder, tokens.vocabulary())
    kept = {r.path.rsplit("/", 1)[1] for r in manifest.collect()}
    assert set(os.listdir(f"{tmp_path}/shards")) == kept and tokenfile.read_shards(manifest).count() == len(SHORT_TEXTS)
    with run_folder(spark) as run:
        found = tokenfile.query(spark, edge_docs(spark, SHORT_TEXTS))
        assert found.count() == len(SHORT_TEXTS)
        place = run.removeprefix("file://")
        assert len(os.listdir(place)) > 1 and all(place in f for f in manifest.sparkSession.read.parquet(run + "/*/manifest").inputFiles())
    assert not os.path.exists(place)
    assert not tokenfile.shared_dir(spark).startswith(run)


def test_shard_reads_only_what_is_asked(tmp_path):
    writer = tokenfile.ShardWriter(f"file://{tmp_path}/s")
    docs = [np.arange(n, dtype="<u4") for n in (0, 5, 4000, 7)]
    for i, ids in enumerate(docs):
        writer.add(None if i == 1 else 10 + i, ids)
    uri = writer.close()
    shard = tokenfile.Shard(uri)
    assert shard.doc_ids == [10, None, 12, 13]
    for i in (3, 0, 2, 1):
        assert shard.read(i).tolist() == docs[i].tolist()
    path = uri.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    import zstandard

    # any decoder passes over the skippable frames
    whole = zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read()
    assert whole == b"".join(d.astype("<u2").tobytes() for d in docs)
    first = int(shard.starts[2])
    data[first + 20] ^= 0xFF  # damage one frame: the others still read
    open(path, "wb").write(data)
    damaged = tokenfile.Shard(uri)
    assert damaged.read(3).tolist() == docs[3].tolist()
    with pytest.raises((ValueError, zstandard.ZstdError)):
        damaged.read(2)


# --------------------------------------------------------------------- packing


def _least_bins(sizes, capacity):
    """Fewest sequences, by trying everything."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1 :])
        place(i + 1, rooms + [capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_reduction_never_costs_a_sequence():
    rng = random.Random(4)
    for _ in range(250):
        capacity = rng.choice([10, 13, 20])
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = np.bincount(sizes, minlength=capacity + 1)
        fixed = packing.reduced(counts)
        rest = [s for s in range(capacity + 1) for _ in range(counts[s])]
        used = sorted(s for p in fixed for s, n in p.items for _ in range(n * p.repeats))
        assert sorted(used + rest) == sorted(sizes)
        assert all(p.size <= capacity for p in fixed)
        assert sum(p.repeats for p in fixed) + _least_bins(rest, capacity) == _least_bins(sizes, capacity)


def test_plan_places_every_piece_once():
    rng = random.Random(9)
    for _ in range(50):
        capacity = rng.choice([16, 64])
        histogram = {s: rng.randint(0, 30) for s in range(1, capacity + 1)}
        found = packing.plan(histogram, capacity)
        packed = np.zeros(capacity + 1, int)
        for p in found.patterns:
            assert p.size <= capacity and p.repeats > 0
            for s, n in p.items:
                packed[s] += n * p.repeats
        assert {s: int(packed[s]) for s in histogram} == histogram
        plain = packing.best_fit(np.array([0] + [histogram[s] for s in range(1, capacity + 1)]))
        assert found.n_sequences <= sum(p.repeats for p in plain) + 1


def _check_packing(docs, encode):
    texts = docs.select("doc_id", "text").collect()
    rows = packing.query(docs).collect()
    held = {}
    for r in rows:
        assert 1 <= r.length <= 2048 and r.offset + r.length <= 2048
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
    want = []
    for t in texts:
        ids = np.array(plain(encode, t.text) + [0], "<u4")
        first = len(ids) % 2048 or 2048
        edges = [0, *range(first, len(ids) + 1, 2048)]
        want += [(t.doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    tokens_ = sum(r.length for r in rows)
    return len(held), -(-tokens_ // 2048)


def test_packing(spark, encode, monkeypatch):
    monkeypatch.setattr(packing, "SALT_PIECES", 20)  # lengths are dealt out
    used, least = _check_packing(documents(spark), encode)
    assert used <= least + 2
    _check_packing(edge_docs(spark), encode)
    assert packing.query(empty_docs(spark)).collect() == []


def test_packed_ids_are_the_pieces(spark, encode):
    docs = edge_docs(spark, SHORT_TEXTS[:3])
    for r in packing.pack(docs).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length


# ----------------------------------------------------------------- edit counts


def test_tree_counts_every_edited_text(encode, monkeypatch):
    monkeypatch.setattr(edit_counts, "LEAF_CHUNKS", 3)
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50)))
        tree = edit_counts.CountTree(text, encode)
        for _ in range(5):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 1, 2, 5, 30]))
            new = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4)))
            tree.replace(a, b, new)
            text = text[:a] + new + text[b:]
            assert (tree.text(), tree.n_chars, tree.n_tokens) == (text, len(text), len(plain(encode, text)))


def test_edits_touch_little(encode):
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = edit_counts.CountTree(text, encode)
    tree.apply([(100, 105, "X"), (60_000, 60_000, " new words"), (9, 9, "")])
    assert tree.n_encoded < 6 * edit_counts.LEAF_CHUNKS
    with pytest.raises(ValueError):
        tree.apply([(5, 9, "a"), (8, 12, "b")])
    with pytest.raises(ValueError):
        tree.replace(0, len(text) + 50, "")


def test_counts_of_tables(spark, encode):
    for docs in (documents(spark), edge_docs(spark)):
        got = sorted((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_edited) for r in edit_counts.query(docs.fillna(-1, ["doc_id"])).collect())
        want = []
        for r in docs.select("doc_id", "text").collect():
            text = r.text or ""
            edits = edit_counts.cleaning_edits(text)
            edited = text
            for a, b, new in sorted(edits, reverse=True):
                edited = edited[:a] + new + edited[b:]
            want.append((-1 if r.doc_id is None else r.doc_id, len(plain(encode, text)), len(edits), len(plain(encode, edited))))
        assert got == sorted(want)
    assert edit_counts.query(empty_docs(spark)).collect() == []
    assert len(EDGE_TEXTS) == edit_counts.query(edge_docs(spark)).count()


def test_rounds_of_edits_read_edited_blocks_only(spark, encode):
    """Three rounds over kept trees: counts of the whole edited texts, blocks read and chunks encoded near the edits."""
    rng = random.Random(12)
    long = " ".join(f"word{i}" for i in range(3000))
    texts = [long, *("".join(rng.choice(PARTS) for _ in range(rng.randint(0, 400))) for _ in range(12)), "", None]
    docs = edge_docs(spark, list(enumerate(texts)))
    table = edit_counts.TreeTable.build(keyed(docs), tokens.vocabulary())
    ids = {r["_row"]: r.doc_id for r in table.sums().select("_row", "doc_id").collect()}
    now = {row: texts[i] or "" for row, i in ids.items()}
    for round_ in (1, 2, 3):
        rows = []
        for row, text in list(now.items()):
            at, edits = 0, []
            while at <= len(text) and rng.random() < 0.7 and len(edits) < 3:
                a = min(len(text), at + rng.randint(0, 40 if ids[row] else 5000))
                b = min(len(text), a + rng.choice([0, 0, 1, 7, 60]))
                edits.append((a, b, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 3)))))
                at = b + 1
            rows += [(row, *e) for e in edits]
            for a, b, new in reversed(edits):
                text = text[:a] + new + text[b:]
            now[row] = text
        rows += [(10**9, 0, 0, "no such document")]
        table = table.edited(spark.createDataFrame(rows, "_row long, start long, end long, text string"))
        got = {r["_row"]: r.n_tokens for r in table.sums().select("_row", "n_tokens").collect()}
        assert got == {row: len(plain(encode, text)) for row, text in now.items()}
        last = {r["_row"]: r for r in table.rounds[round_].collect()}
        assert set(last) == {r[0] for r in rows} - {10**9}
        for row, r in last.items():
            n = sum(e[0] == row for e in rows)
            if ids[row] == 0:
                assert r.n_blocks_read <= 4 * n and len(r.chars) > 8 * 80 and len(r.leaves) <= 3 * n
                assert r.n_encoded <= 4 * n * 2 * edit_counts.LEAF_CHUNKS
