"""Cases where an operator once did less than its whole job."""

import time

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import xxhash

from edge_rows import EDGE_ROWS, LONG
from fairlead.llm import (
    chat,
    embedding_dedup,
    fingerprints,
    packing,
    piece_dropout,
    quality,
    queries,
    secrets,
    sharding,
    substring_dedup,
)

FOLDER = "/root/testdata/sf0.001"

LETTERS = list("abcdefghijklmnopqrstuvwxyz")
ALNUM = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def drawn(rng, prefix, alphabet, length):
    return prefix + "".join(rng.choice(alphabet, length))


@pytest.mark.parametrize("n_words, n_planted", [(600, 30), (600, 150), (9000, 300), (9000, 1500)])
def test_unlabelled_credentials_of_a_known_format_are_found(spark, n_words, n_planted):
    rng = np.random.default_rng(n_words + n_planted)
    words = [drawn(rng, "", LETTERS, int(rng.integers(12, 20))) for _ in range(n_words)]
    planted = [drawn(rng, "SK-", ALNUM, 24) for _ in range(n_planted)]
    labelled = [f"api_key = {drawn(rng, 'SK-', ALNUM, 24)} is set" for _ in range(200)]
    texts = labelled + [f"here {x} there" for x in planted] + [" ".join(words[k : k + 30]) for k in range(0, n_words, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.scan(docs, secrets.train(docs)).collect()}
    found = [k for k in range(n_planted) if rows[200 + k].redacted == "here [SECRET] there"]
    assert len(found) >= 0.9 * n_planted
    assert sum(len(rows[k].spans) for k in range(200 + n_planted, len(texts))) <= n_words / 1000


@pytest.mark.parametrize("partitions", [1, 6])
def test_repeated_rows_keep_what_occurs_nowhere_else(spark, partitions):
    alone = " ".join(f"a{k}" for k in range(300))
    within = " ".join(f"b{k % 25}" for k in range(50))
    rows = [(1, alone), (1, alone), (1, alone), (2, within), (2, within), (3, "see " + alone)]
    rows += [(None, "n " + alone.upper()), (None, "n " + alone.upper()), (4, alone + " x"), (4, "y " + within), (4, "y " + within)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    result = substring_dedup.dedup_substrings(docs).collect()
    first = " ".join(f"b{k}" for k in range(25))
    kept = {1: {alone}, 2: {first}, 3: {"see"}, None: {"n " + alone.upper()}, 4: {"x", "y"}}
    assert len(result) == len(rows)
    assert {i: {r.kept for r in result if r.doc_id == i} for i in kept} == kept


def test_windows_of_one_hash_are_told_apart(spark, monkeypatch):
    """Two copies of a record, and the words compared one by one."""
    monkeypatch.setattr(substring_dedup, "same_bytes", lambda text, a, b, n: np.zeros(len(a), dtype=bool))
    text = " ".join(f"c{k}" for k in range(30)).encode() + b" "
    blobs = [
        substring_dedup._pack(np.array([i]), np.array([0]), np.array([0]), np.array([11]), [text]) for i in (5, 5, 6)
    ]
    assert np.concatenate(substring_dedup._bucket_ranges(blobs, 20)).tolist() == [6, 0, 0, 30]


def test_every_occurrence_of_a_word_draws_its_own_merges():
    pieces = piece_dropout.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    text = b"international the " * 4000
    whole = piece_dropout.Encoder(pieces, 0.1, 1)
    ids = np.frombuffer(whole.encode([text], [7])[0], "<u4")
    assert pieces.decode(ids) == text
    # A word of n characters with only one merge: skipped in a tenth of its places.
    one = next(w for w in (f" {a}".encode() for a in "abcdefghijklmnopqrstuvwxyz") if len(pieces.candidates(w)) == 1)
    ids = np.frombuffer(whole.encode([one[1:] + one * 9999], [3])[0], "<u4")
    assert 0.09 < (len(ids) - 10_000) / 10_000 < 0.11
    # More segmentations than a handful, the same by any division into blocks, others by document and seed.
    words = [b" international"] * 4000
    keys = whole._keys([7], [0], [4000])
    assert len(set(whole._block(words, keys))) > 40
    assert whole._block(words, keys) == pieces.segment(words, 0.1, keys)
    assert whole.encode([text], [7]) == piece_dropout.Encoder(pieces, 0.1, 1).encode([text], [7])
    assert whole.encode([text], [7]) != whole.encode([text], [8])
    assert whole.encode([text], [7]) != piece_dropout.Encoder(pieces, 0.1, 2).encode([text], [7])


def test_remembered_segmentations_are_those_of_the_draw(monkeypatch):
    pieces = piece_dropout.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    text = ("  two \n\u2581literal\u2581 \u65e5\u672c\u8a9e na\u00efve \U0001f600x " + "long" * 30 + " " + "word" * 8 + " ends").encode() * 50
    words = [w for part in piece_dropout._segments(text) for w in part]
    encoder = piece_dropout.Encoder(pieces, 0.3, 4)
    expected = b"".join(pieces.segment(words, 0.3, encoder._keys([9], [0], [len(words)])))
    assert encoder.encode([text], [9]) == [expected]
    monkeypatch.setattr(piece_dropout, "BLOCK_WORDS", 7)
    assert encoder.encode([text, b"", text], [9, 1, 9]) == [expected, b"", expected]


def test_a_credential_around_a_base_span_is_found_whole(spark):
    rng = np.random.default_rng(8)
    words = [drawn(rng, "", LETTERS, int(rng.integers(12, 20))) for _ in range(600)]
    key = lambda: drawn(rng, "SK-", list("0123456789abcdef"), 16) + drawn(rng, "-", ALNUM, 8)
    texts = [f"api_key = {key()} is set" for _ in range(300)] + [f"here {key()} there" for _ in range(40)]
    texts += [" ".join(words[k : k + 30]) for k in range(0, 600, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.scan(docs, secrets.train(docs)).collect()}
    whole = [k for k in range(300, 340) if rows[k].redacted == "here [SECRET] there"]
    assert len(whole) >= 36
    assert all([(s.kind, s.base) for s in rows[k].spans] == [("assign", False), ("hex", True)] for k in whole)


@pytest.mark.parametrize("low, high, saved", [(900, 1500, 15), (300, 700, 5), (1000, 3000, 0), (10, 300, 0), (1400, 2000, 0)])
def test_local_search_is_tried_at_every_length_and_cheap(low, high, saved):
    lengths = sorted(np.random.default_rng(0).integers(low, high + 1, 2000).tolist(), reverse=True)
    fitted = packing.best_fit(lengths, 4096)
    started = time.process_time()
    bins = packing.improve(fitted, lengths, 4096)
    assert time.process_time() - started < 2
    assert sorted(k for b in bins for k in b) == list(range(2000))
    fills = [sum(lengths[k] for k in b) for b in bins]
    assert max(fills) <= 4096 and len(bins) <= len(fitted) - saved
    # Documents move into the fullest bins, whether a bin runs empty or not.
    before = sum(sum(lengths[k] for k in b) ** 2 for b in fitted)
    assert sum(f**2 for f in fills) >= before and (saved == 0 or sum(f**2 for f in fills) > before)


def test_bins_that_never_fill_up_meet_once_more(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 60)
    rng = np.random.default_rng(4)
    lengths = rng.integers(900, 1501, 600).tolist()
    pieces = spark.createDataFrame(list(enumerate(lengths)), "key long, length long")
    placed = packing.place(pieces).collect()
    bins = {}
    for row in placed:
        bins.setdefault(row.sequence_id, []).append((row.offset, lengths[row.key]))
    assert sorted(r.key for r in placed) == list(range(600))
    for places in bins.values():
        assert [o for o, _ in sorted(places)] == np.cumsum([0, *[n for _, n in sorted(places)]])[:-1].tolist()
        assert sum(n for _, n in places) <= 4096
    assert len(bins) < len(packing.best_fit(sorted(lengths, reverse=True), 4096))


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_registered_queries_return_their_columns(spark, name):
    """Each registered function over its whole small table, with the row count of its contract."""
    columns = {
        "op1_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op2_substring_dedup": "doc_id n_words n_removed kept_sha256",
        "op3_sharding": "doc_id size text_crc32 law shard slot grown_shard",
        "op4_embedding_dedup": "vec_id n_links component_id kept",
        "op5_packing": "doc_id piece start length ids_crc32 sequence_id offset",
        "op6_sentencepiece": "doc_id n_ids ids_crc32 decoded_sha256 lossless",
        "op7_quality": "doc_id held_out score predicted",
        "op8_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op9_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op10_simhash_dedup": "doc_id fingerprint component_id",
        "op11_line_dedup": "doc_id n_lines n_dropped kept_sha256",
        "op12_centroid_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
        "op13_source_divergence": "lang source part item value rank",
    }
    frame = queries.registered()[name](spark, FOLDER)
    assert set(columns[name].split()) <= set(frame.columns)
    rows = frame.collect()
    table = {"op1_chat_formatting": "conversations", "op4_embedding_dedup": "embeddings", "op12_centroid_clustering": "embeddings"}
    source = spark.read.parquet(f"{FOLDER}/{table.get(name, 'documents')}.parquet")
    if name == "op1_chat_formatting":
        assert len(rows) == source.select("conv_id").distinct().count() + 1
    elif name == "op5_packing":
        assert {r.doc_id for r in rows} == {r.doc_id for r in source.select("doc_id").collect()}
    elif name != "op13_source_divergence":
        assert len(rows) == source.count()
    if name == "op6_sentencepiece":
        assert all(r.lossless for r in rows)


def test_a_large_system_turn_is_kept_wherever_it_fits(spark):
    long, short = "s " * 110, "word " * 20
    rows = [(1, 0, "system", long)] + [(1, k, "assistant" if k % 2 else "user", short) for k in range(1, 30)]
    rows += [(1, 30, "user", "word " * 150), (1, 31, "assistant", short)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_conversations(turns, public_tokenizers.path("byte_bpe_50k.json"), budget=200, history=60).collect()
    system = [w for w in windows if chat.read_turns(w.formatted)[0] == ("system", long)]
    without = [w for w in windows if w not in system]
    # Only the turn of 150 words leaves no room for it.
    assert len(without) == 1 and "word " * 150 in without[0].formatted
    assert len(system) > 10 and all(w.tokens <= 200 for w in system)


def xx(value, seed):
    """Spark's xxhash64 of an int, a long or a string; a null leaves the seed."""
    if value is None:
        return seed
    data = value.encode() if isinstance(value, str) else value[0].to_bytes(value[1], "little", signed=True)
    return xxhash.xxh64_intdigest(data, seed)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


@pytest.mark.parametrize("partitions", [1, 5])
def test_shards_replayed_in_plain_python(spark, monkeypatch, partitions):
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 4096)
    monkeypatch.setattr(sharding, "COPIES", 7)
    monkeypatch.setattr(sharding, "BUCKET_GROUP", 3)
    rows = [(i, t) for i, t in EDGE_ROWS] + [(k, f"text {k} " * (k % 9)) for k in range(100, 400)] + [(50, "copy " * 30)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    seed, shards = 2024, 5
    found = sharding.shard_documents(docs, shards, seed).collect()
    buckets = max(16, -(-sum(len((t or "").encode()) for _, t in rows) // 4096))
    copies, dealt = {}, {}
    for i, t in rows:
        copy = copies[i, t] = copies.get((i, t), -1) + 1
        start = xx((seed, 4), 42)
        key = xx(t, xx(None if i is None else (i, 8), start))
        bucket = signed(xx((copy, 8), key)) % buckets
        plain = signed(xx(t, xx(None if i is None else (i, 8), 42)))
        dealt.setdefault(bucket, []).append(((i is not None, i or 0), plain, (t is not None, (t or "").encode()), t))
    expected, offset = [], 0
    for bucket in sorted(dealt):
        ordered = sorted(dealt[bucket])
        for place, k in enumerate(np.random.Generator(np.random.PCG64([seed, bucket])).permutation(len(ordered)).tolist()):
            (known, i), _, _, t = ordered[k]
            at = offset + place
            expected.append((i if known else None, len((t or "").encode()) + 1, at % shards, at // shards))
        offset += len(ordered)
    assert sorted(((r.doc_id, r.size, r.shard, r.slot) for r in found), key=repr) == sorted(expected, key=repr)
    # Two hundred copies of a row are no bucket of their own.
    sizes = [sum(row[0] == (True, 50) for row in members) for members in dealt.values()]
    assert max(sizes) < 40


def votes_of(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    terms = [words[k : k + 3] for k in range(max(1, len(words) - 2))] if words else []
    counts = np.zeros(128, dtype=np.int64)
    for term in terms:
        h0 = 42
        for word in term:
            h0 = xx(word, h0)
        h1 = xx((1, 4), xx((signed(h0), 8), 42))
        counts[:64] += (h0 >> np.arange(64, dtype=np.uint64).astype(object) & 1).astype(np.int64)
        counts[64:] += (h1 >> np.arange(64, dtype=np.uint64).astype(object) & 1).astype(np.int64)
    bits = [2 * int(c) > len(terms) for c in counts]
    high, low = (sum(1 << b for b in range(64) if bits[part + b]) for part in (0, 64))
    return f"{high:016x}{low:016x}"


def test_fingerprints_recounted_in_plain_python(spark):
    huge = " ".join(f"t{k % 331}" for k in range(65_000))
    rows = [(1, "one"), (2, "one two"), (3, "one two three one two three four"), (4, LONG[:40_000]), (5, None), (6, huge), (7, " \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect()}
    texts = [t or "" for _, t in rows]
    prints = [votes_of(t) for t in texts]
    same = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
    for k, (i, _) in enumerate(rows):
        n, then = len(texts[k]), (k + 1) % len(rows)
        edited = votes_of(texts[k][: n - n // 2] + texts[then][: n // 2])
        row = found[i]
        assert (row.fingerprint, row.edited_fingerprint) == (prints[k], edited)
        assert row.near_edited == pytest.approx(same(prints[k], edited))
        assert row.near_next == pytest.approx(same(prints[k], prints[then]))


def test_base_spans_of_a_whole_table_equal_plain_patterns(spark):
    import hashlib
    import re

    kinds = {
        "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII),
        "access": re.compile(r"AKIA[A-Z0-9]+"),
        "hex": re.compile(r"[0-9a-f]+"),
    }
    least = {"assign": 12, "access": 18, "hex": 16}
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in secrets.digest(secrets.scan(table, secrets.train(table))).collect()}
    total = 0
    for row in table.select("doc_id", "text").collect():
        spans = []
        for order, (kind, pattern) in enumerate(kinds.items()):
            for m in pattern.finditer(row.text or ""):
                if len(m[2] if kind == "assign" else m[0]) >= least[kind]:
                    spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
        joined = ",".join(x for _, _, x in sorted(spans))
        mine = found[row.doc_id]
        assert mine.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [mine.n_assign, mine.n_access, mine.n_hex] == [sum(o == k for _, o, _ in spans) for k in range(3)]
        assert set(joined.split(",")) - {""} <= set(mine.spans.split(","))
        total += len(spans)
    assert total > 20


@pytest.mark.parametrize("n_labelled, length", [(6, 24), (19, 24), (21, 24), (200, 250), (200, 300), (60, 5000)])
def test_formats_are_learned_below_and_above_the_old_bounds(spark, n_labelled, length):
    """Kinds of few values, and values beyond 256 and 4,096 bytes, on both sides of bounds there once were."""
    rng = np.random.default_rng(n_labelled + length)
    words = [drawn(rng, "", LETTERS, int(rng.integers(12, 20))) for _ in range(900)]
    labelled = [f"api_key = {drawn(rng, 'SK-', ALNUM, length)} is set" for _ in range(n_labelled)]
    planted = [drawn(rng, "SK-", ALNUM, length) for _ in range(20)]
    texts = labelled + [f"here {x} there" for x in planted] + [" ".join(words[k : k + 30]) for k in range(0, 900, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.scan(docs, secrets.train(docs)).collect()}
    found = sum(rows[n_labelled + k].redacted == "here [SECRET] there" for k in range(20))
    assert found >= 18
    assert sum(len(rows[k].spans) for k in range(n_labelled + 20, len(texts))) <= 1


def test_quality_learns_from_whole_documents(spark):
    good = "This is a line of plain and pleasant prose, written with some care."
    bad = "$$$ CLICK HERE!!! >>> FREE $$$ 999999 ###"
    rows, labels = [], []
    for k in range(120):
        # What tells the two apart stands after two hundred blank lines.
        rows.append((k, "\n" * 200 + "\n".join([good if k % 2 else bad] * 40)))
        labels.append((k, k % 2, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.classify(docs, marks).where("held_out").collect()
    assert found and all(r.predicted == r.doc_id % 2 for r in found)
    # A bound on all lines takes fewer documents, never parts of them.
    few = quality.train(docs, marks, sample_lines=1000)
    assert {r.score > 0.5 for r in quality.score(docs, few).collect()} == {True, False}
    assert {r.score for r in quality.score(docs, quality.train(docs, marks, sample_lines=100)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), marks).collect() == []


def test_dense_groups_in_a_shard_are_counted_exactly_in_linear_memory():
    rng = np.random.default_rng(8)
    n, dense, dim = 6000, 2500, 24
    x = rng.normal(size=(n, dim))
    centre = rng.normal(size=dim)
    x[:dense] = centre / np.linalg.norm(centre) * np.sqrt(dim) + rng.normal(size=(dense, dim)) * 0.13
    x[dense : dense + 300 : 2] = x[dense + 1 : dense + 300 : 2] + rng.normal(size=(150, dim)) * 0.1
    x = x[rng.permutation(n)]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = unit @ unit.T >= 0.95
    np.fill_diagonal(true, False)
    copies = rng.integers(1, 4, n)
    keys = np.arange(n) * 7 + 3
    started = time.process_time()
    # Half of the vectors are the shard's own, all of them ask.
    shard = embedding_dedup.Shard(keys[: n // 2], copies[: n // 2], x[: n // 2], 0.95)
    counts, edges = np.zeros(n, dtype=np.int64), []
    order = rng.permutation(n)
    for k in range(0, n, 1024):
        rows = order[k : k + 1024]
        c, a, b = shard.links(keys[rows], x[rows])
        counts[rows] = c
        edges += list(zip(a.tolist(), b.tolist()))
    assert time.process_time() - started < 60
    expected = true[:, : n // 2] @ copies[: n // 2]
    assert (counts == expected).mean() > 0.9995
    # Links between trees only: about one for each query that has any, not one for each pair.
    assert len(edges) < 2 * n < true.sum() / 100
    parent = list(range(n))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        parent[root((a - 3) // 7)] = root((b - 3) // 7)
    linked = [k for k in range(n) if expected[k]]
    members = [k for k in linked if expected[k] > 1000]
    assert len(members) > 1000 and len({root(k) for k in members}) == 1
    assert shard.recall >= embedding_dedup.AUDIT_RECALL


def test_every_shard_has_a_lane_of_its_own(spark):
    for shards in (6, 50):
        lanes = embedding_dedup._lanes(spark, shards)
        spread = lanes.repartition(shards, "lane").selectExpr("shard", "spark_partition_id() AS part").collect()
        assert len(spread) == shards == len({r.part for r in spread})


def test_pipeline_stages_on_awkward_rows_and_on_none(spark, edge_docs, no_docs):
    columns = list(corpus_pipeline.COLUMNS)
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, edge_docs, FOLDER)
        assert stage(spark, no_docs, FOLDER).collect() == []
        if name == "best-fit packing":
            packed = made.collect()
            assert sorted(str(i) for r in packed for i in set(r.doc_ids)) and max(r.length for r in packed) <= 4096
            assert sum(len(r.ids) for r in packed) == 4 * sum(r.length for r in packed)
            assert {str(i) for r in packed for i in r.doc_ids} == {str(i) for i, _ in rows}
            continue
        found = made.collect()
        assert made.columns == columns
        assert all(r.n_chars == len(r.text or "") for r in found) or name in ("quality classifier", "SimHash near-dedup")
        if name in ("substring dedup", "secret scans"):
            # Every row stays, null texts stay null and others do not become so.
            assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
            assert sorted(str(r.doc_id) for r in found if r.text is None) == sorted(str(i) for i, t in rows if t is None)
        if name == "SimHash near-dedup":
            assert len(found) == len({(r.doc_id, r.text) for r in found}) < len(rows)
            assert [r.doc_id for r in found if (r.text or "").split() == []] == [3]
        if name == "secret scans":
            assert not any("24be64439e3e49cf46b2d7c90f3602a3d0b907ff" in (r.text or "") for r in found)
