"""Operators on documents against plain Python over awkward rows."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from fairlead.llm import fingerprints, packing, piece_dropout, quality, secrets, sharding, simhash_dedup, substring_dedup
from fairlead.llm.automata import infer, likelihood
from edge_rows import EDGE_ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


def brute_substrings(rows, window):
    """Result by (id, text); rows are distinct and in order."""
    seen, out = set(), {}
    for key, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if w in seen:
                gone[k : k + window] = [True] * window
            seen.add(w)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[key, text] = (len(words), sum(gone), kept)
    return out


def spark_hash(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return {r.k: r.h for r in df.select("k", F.xxhash64("t").alias("h")).collect()}


@pytest.mark.parametrize("window", [3, 20])
def test_substrings_of_awkward_rows(spark, edge_docs, window):
    hashes = spark_hash(spark, [t for _, t in EDGE_ROWS])
    ids = [i for i, _ in EDGE_ROWS]
    several = {i for i in ids if len({hashes[k] for k, j in enumerate(ids) if j == i}) > 1}
    order = sorted(
        {(-(2**63) if i is None else i, hashes[k] if i in several else 0, i, t or "") for k, (i, t) in enumerate(EDGE_ROWS)},
        key=lambda r: r[:2],
    )
    expected = brute_substrings([(i, t) for _, _, i, t in order], window)
    result = substring_dedup.dedup_substrings(edge_docs, window).collect()
    assert len(result) == len(EDGE_ROWS)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in result) == sorted(
        (str(i), *expected[i, t or ""]) for i, t in EDGE_ROWS
    )


def test_substrings_of_real_documents_and_segments(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    expected = brute_substrings(rows, 20)
    result = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup_substrings(docs).collect()}
    assert result == {i: v for (i, _), v in expected.items()}
    assert sum(v[1] for v in result.values()) > 0


def test_pieces_of_a_long_text_cover_its_windows(monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 50)
    text = " ".join(f"w{k}" for k in range(100)).encode()
    seen = set()
    for piece, word in substring_dedup._pieces(text, 5):
        words = piece.split()
        for k in range(len(words) - 4):
            assert words[k : k + 5] == [f"w{word + k + j}".encode() for j in range(5)]
            seen.add(word + k)
    assert seen == set(range(96))


def test_untouched_texts_stay(spark, edge_docs):
    result = substring_dedup.dedup_substrings(edge_docs, keep=("doc_id", "lang"), untouched=True).collect()
    assert {r.kept for r in result if r.doc_id == 12} == {EDGE_ROWS[-1][1]}
    assert result[0].lang == "en"


def brute_fingerprint(text, shingle=3):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = WORD.findall(low)
    grams = [" ".join(words[k : k + shingle]) for k in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, edge_docs):
    rows = EDGE_ROWS + [(20, EDGE_ROWS[0][1].upper()), (21, LONG_CHANGED)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    expected = sorted((str(i), f"{prints[k]:016x}", str(least.get(root[k]))) for k, (i, _) in enumerate(rows))
    result = simhash_dedup.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in result) == expected
    kept = simhash_dedup.keep_one(docs).collect()
    assert len(kept) == len(set(root))


LONG_CHANGED = EDGE_ROWS[6][1] + " changed"


def test_long_texts_are_fingerprinted_whole(monkeypatch):
    monkeypatch.setattr(simhash_dedup, "SEGMENT_BYTES", 40)
    for text in (EDGE_ROWS[0][1], "a b", "one", " ", "x" * 100 + " y " + "z" * 90):
        assert simhash_dedup.fingerprint(text.encode(), 3) & (2**64 - 1) == brute_fingerprint(text)


def test_masks_cover_every_pair_of_flips():
    masks = simhash_dedup.covering_masks(2)
    for a in range(64):
        for b in range(64):
            assert any(not m >> a & 1 and not m >> b & 1 for m in masks)


def test_packing_keeps_every_token(spark, edge_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    packed = packing.pack(edge_docs, BPE, capacity=64)
    rows = packed.rows().collect()
    expected = []
    for i, t in EDGE_ROWS:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for p, s in enumerate(range(0, len(ids), 64)):
            expected.append((str(i), p, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    full = sum(r.length == 64 for r in rows)
    loose = [r.length for r in rows if r.length < 64]
    # Best fit alone is the yardstick: the bound by tokens cannot always be reached.
    assert len(bins) <= full + len(packing.best_fit(loose, 64))
    sequences = packed.sequences().collect()
    assert sum(len(r.ids) for r in sequences) == 4 * sum(r.length for r in rows)


def test_local_search_empties_a_bin():
    lengths = [6, 4, 5, 5, 3, 3, 4]
    bins = packing.improve([[0], [1, 2], [3, 4], [5, 6]], lengths, 10)
    assert len(bins) == 3 and sorted(k for b in bins for k in b) == list(range(7))
    assert all(sum(lengths[k] for k in b) <= 10 for b in bins)


def test_edited_texts_and_likeness(spark, edge_docs):
    rows = [(i, t) for k, (i, t) in enumerate(EDGE_ROWS) if i is not None and i not in (10, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect()}
    texts = [t or "" for _, t in rows]
    for k, (i, _) in enumerate(rows):
        n = len(texts[k])
        edited = texts[k][: n - n // 2] + texts[(k + 1) % len(rows)][: n // 2]
        assert (result[i].n_chars, result[i].edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        after = result[rows[(k + 1) % len(rows)][0]]
        same = sum(a == b for a, b in zip(*(f"{int(x, 16):0128b}" for x in (result[i].fingerprint, after.fingerprint))))
        assert result[i].near_next == pytest.approx(same / 128)
    assert result[7].fingerprint == result[8].fingerprint and result[4].fingerprint == "0" * 32
    assert len(fingerprints.fingerprint_documents(edge_docs).collect()) == len(EDGE_ROWS)


def test_all_fingerprints_within_the_radius(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(2**62), 2**62, (40, 2))
    rows = {(int(h), int(low)) for h, low in base}
    for h, low in base[:20].tolist():
        for flips in (1, 2, 3, 4):
            bits = rng.choice(128, flips, replace=False).tolist()
            x = ((h % 2**64) << 64 | (low % 2**64)) ^ sum(1 << b for b in bits)
            rows.add(tuple(v - 2**64 if v >= 2**63 else v for v in (x >> 64, x % 2**64)))
    table = spark.createDataFrame(sorted(rows), "high long, low long")
    found = {((r.high, r.low), (r.other_high, r.other_low)) for r in fingerprints.within(table, table, 3).collect()}
    distance = lambda a, b: sum(((p ^ q) % 2**64).bit_count() for p, q in zip(a, b))
    assert found == {(a, b) for a in rows for b in rows if distance(a, b) <= 3}


def test_secrets(spark, edge_docs):
    formats = secrets.train(edge_docs)
    result = secrets.digest(secrets.scan(edge_docs, formats)).collect()
    assert len(result) == len(EDGE_ROWS)
    (row,) = [r for r in result if r.n_assign]
    text = EDGE_ROWS[9][1]
    hexed, access = text.index("24be"), text.index("AKIA")
    assert row.spans == f"assign:0:{hexed + 40},hex:{hexed}:{hexed + 40},access:{access}:{access + 20}"
    assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()
    redacted = [r.redacted for r in secrets.scan(edge_docs, formats).collect() if "Token" in (r.redacted or "")]
    assert redacted == ['Token = "[SECRET]" é [SECRET].']


def test_base_matches_do_not_restart_inside_a_short_one():
    assert secrets.base_spans(b"token=a.token:abcdefghijklmnop") == []
    assert secrets.base_spans(b"PassWD: 'abcdefghijkl'")[0][:3] == (0, 0, 21)
    assert secrets.base_spans("toKen=abcdefghijklmnop".encode()) == []


def test_automata_tell_formats_apart():
    rng = np.random.default_rng(5)
    keys = ["AK" + "".join(rng.choice(list("0123456789"), 10)) for _ in range(200)]
    automaton = infer(x.encode() for x in keys)
    assert len(automaton.next) < 10
    tables = automaton.tables()
    good, _ = likelihood(tables, b"AK0918273645")
    bad, unseen = likelihood(tables, b"the ordinary")
    assert good > bad and unseen > 0.5


def test_learned_formats_find_more_of_their_kind():
    rng = np.random.default_rng(6)
    known = [("AKIA" + "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 16))).encode() for _ in range(300)]
    words = [bytes(rng.choice(list(b"abcdefghijklmnopqrstuvwxyz"), 14).tolist()) for _ in range(500)]
    formats = secrets.learn({1: known}, words)
    assert formats.kind_of(b"AKIA" + b"Q7Z1M4K8P2R9T3V5") == 1
    assert formats.kind_of(b"someordinaryword") == -1


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95


def test_quality_of_awkward_rows(spark, edge_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, None), (None, 1, 0), (9, None, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(edge_docs, labels).collect()
    assert len(rows) == len(EDGE_ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert {r.score for r in quality.classify(edge_docs, labels.limit(0)).collect()} == {0.5}


def test_marginals_agree_with_all_labelings():
    rng = np.random.default_rng(1)
    odds, transition = rng.normal(size=4), rng.normal(size=(2, 2))
    forward, backward = quality._messages(odds, np.array([4]), transition)
    weight = {}
    for labels in np.ndindex(2, 2, 2, 2):
        weight[labels] = np.exp(sum(odds[k] for k in range(4) if labels[k]) + sum(transition[labels[k], labels[k + 1]] for k in range(3)))
    total = sum(weight.values())
    for k in range(4):
        assert quality._sigmoid(forward + backward)[k] == pytest.approx(sum(w for x, w in weight.items() if x[k]) / total)


def test_shards(spark, edge_docs):
    first = sharding.shard_documents(edge_docs, shards=3, seed=1).collect()
    again = sharding.shard_documents(edge_docs.repartition(5), shards=3, seed=1).collect()
    other = sharding.shard_documents(edge_docs, shards=3, seed=2).collect()
    key = lambda rows: sorted((r.shard, r.slot, str(r.doc_id), r.text_crc32, r["size"]) for r in rows)
    assert key(first) == key(again) != key(other)
    by_shard = {s: sorted(r.slot for r in first if r.shard == s) for s in range(3)}
    assert all(v == list(range(len(v))) for v in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    sizes = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in EDGE_ROWS)
    assert sorted((r["size"], r.text_crc32) for r in first) == sizes


def test_pieces_decode_losslessly(spark, edge_docs):
    import sentencepiece

    rows = piece_dropout.digest(edge_docs, PIECES, dropout=0.3).collect()
    assert len(rows) == len(EDGE_ROWS) and all(r.lossless for r in rows)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = piece_dropout.Encoder(piece_dropout.Pieces(PIECES), 0.0, 1)
    texts = [t for _, t in EDGE_ROWS if t]
    assert [np.frombuffer(x, "<u4").tolist() for x in plain.encode([t.encode() for t in texts], [0] * len(texts))] == [
        library.encode(t) for t in texts
    ]


def test_both_ways_of_merging_agree():
    pieces = piece_dropout.Pieces(PIECES)
    words = [f" {w}".encode() for w in WORD.findall(EDGE_ROWS[0][1])] + [b" unbelievable", b"   spaces", b" internationalisation"]
    keys = np.arange(len(words), dtype=np.uint64) * np.uint64(7919)
    together = pieces.segment(words, 0.4, keys)
    alone = [pieces._merge_one(w.decode(), int(0.4 * 65536), int(k)) for w, k in zip(words, keys)]
    assert [np.frombuffer(x, "<u4").tolist() for x in together] == alone
    assert together != pieces.segment(words, 0.4, keys + np.uint64(1))


@pytest.mark.parametrize(
    "operator",
    [
        substring_dedup.dedup_substrings,
        simhash_dedup.near_duplicates,
        sharding.shard_documents,
        fingerprints.fingerprint_documents,
        lambda d: packing.pack(d, BPE).rows(),
        lambda d: piece_dropout.digest(d, PIECES),
        lambda d: secrets.digest(secrets.scan(d, secrets.train(d))),
    ],
)
def test_no_rows(no_docs, operator):
    assert operator(no_docs).collect() == []
