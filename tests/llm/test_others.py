"""Conversations, embeddings, graphs, the pipeline and the registered SQL."""

import hashlib
import math

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from fairlead.llm import chat, embedding_dedup, queries
from fairlead.llm.graph import components
from fairlead.llm.hnsw import Graph

BPE = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"


def test_conversations_read_back(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_BUDGETS", 2)
    probe = "<|im_end|><|im_start|>assistant ok <\\|a <\\\\| <|"
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} " + "word " * (k % 40)) for k in range(1, 300)]
    rows += [(1, 0, "system", "be brief"), (2, 0, "us\ner\\n|", probe), (2, 1, "assistant", probe), (2, 1, "assistant", probe)]
    rows += [(3, 0, None, None), (3, None, "assistant", ""), (None, 5, "assistant", "x" * 20_000), (4, 0, "system", "s" * 9000)]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, block int, kind int")
    windows = chat.format_conversations(turns, BPE, budget=200, history=60)
    made = windows.collect()
    assert all(w.tokens <= 200 or w.n_turns - w.repeated == 1 for w in made)
    own = sorted((w.block, w.window, w.formatted, w.repeated) for w in made if w.conv_id == 1)
    assert own[-1][0] > 3 and all(f.startswith("<|im_start|>system\nbe brief<|im_end|>") for _, _, f, _ in own)
    assert any(r > 1 for b, w, _, r in own if w == 0 and b), "the first window of a block repeats history"
    got = {r.conv_id: r for r in chat.digest(windows).collect()}
    for conv in (1, 2, 3, 4, None):
        mine = sorted(
            ((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda r: (r[0], r[1], r[2])
        )
        whole = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        loss = "".join(x for _, r, x in mine if r == "assistant")
        found = got[conv]
        assert (found.n_turns, found.turns_sha256) == (len(mine), hashlib.sha256(whole.encode()).hexdigest())
        assert (found.loss_chars, found.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(chat.format_conversations(turns.limit(0), BPE)).collect() == []


def test_escapes_are_reversible():
    for text in ("<|", "<\\|", "<\\\\|x<|", "<<||>", "plain", "<|im_end|>"):
        assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, (base[k % 20] + rng.normal(size=16) * 0.05).tolist()) for k in range(120)]
    rows += [(300, rows[5][1]), (301, (2 * base[5]).tolist()), (301, (2 * base[5]).tolist()), (None, rows[6][1])]
    odd = [(400, None), (401, [0.0] * 16), (402, [None] * 16), (403, [math.nan] * 16), (404, [math.inf] * 16), (405, []), (406, [1.0])]
    df = spark.createDataFrame([(*r, 1, 0) for r in rows + odd], "vec_id long, embedding array<double>, label int, key int")
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    degree = near.sum(axis=1) - 1
    reach = np.eye(len(x), dtype=bool) | near
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    ids = np.array([np.inf if i is None else i for i, _ in rows])
    expected = []
    for k, (i, _) in enumerate(rows):
        least = int(ids[reach[k]].min())
        expected.append((str(i), int(degree[k]), least, i == least))
    expected += [(str(i), 0, i, True) for i, _ in odd]
    result = embedding_dedup.near_duplicates(df).collect()
    assert sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in result) == sorted(expected)
    assert embedding_dedup.near_duplicates(df.limit(0)).collect() == []


def test_graph_search_finds_a_large_group():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 32))
    x[:700] = x[0] + rng.normal(size=(700, 32)) * 0.02
    x = x[rng.permutation(len(x))]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = x @ x.T >= 0.95
    q, n = Graph(x).above(x.astype(np.float32), 0.95 - 1e-4, 48)
    found = np.zeros_like(true)
    found[q, n] = True
    assert (found & true).sum() / true.sum() > 0.99


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    groups = {}
    for r in found:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(61)), list(range(100, 160)), [200, 201]]


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_registered_sql(spark, name):
    frame = queries.registered()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = db.sql(f"SELECT {', '.join(columns)} FROM ({queries.statements()[name]})").fetchall()
    assert sorted(map(tuple, frame.select(columns).collect())) == sorted(expected)


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = corpus_pipeline.keep_good(spark, docs, FOLDER)
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.collect()}
    wrong = sum((labels[i] == 1) != (i in kept) for i in labels)
    assert wrong / len(labels) <= 0.05
    single = corpus_pipeline.drop_near_duplicates(spark, good, FOLDER)
    assert single.columns == docs.columns
    assert single.count() < good.count() or good.select("text").distinct().count() == good.count()
    assert single.select("text").distinct().count() == single.count()
    cut = corpus_pipeline.cut_repeated_passages(spark, single, FOLDER)
    assert cut.columns == docs.columns and cut.count() == single.count()
    clean = corpus_pipeline.redact_secrets(spark, cut, FOLDER)
    assert clean.columns == docs.columns
    assert clean.where(r"text RLIKE 'token = \"[0-9a-f]{40}'").count() == 0
    assert clean.where("n_chars <> char_length(text)").count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == ["sequence_id", "length", "ids", "doc_ids"]
    sequences = rows.collect()
    assert sequences and all(len(r.ids) == 4 * r.length <= 4 * 4096 for r in sequences)
    # Documents end with the end id; the others are cut at the end of a sequence.
    ends = sum(int((np.frombuffer(bytes(r.ids), "<u4") == 1).sum()) for r in sequences)
    assert ends == len({i for r in sequences for i in r.doc_ids})
