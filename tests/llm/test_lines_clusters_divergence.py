"""Line dedup, centroid clustering and source divergence against plain Python on awkward rows."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from edge_rows import LONG, PASSAGE
from pyspark.sql import functions as F

from fairlead.llm import centroid_clustering, line_dedup, queries, source_divergence
from fairlead.llm.common import stored

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\f\r"


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_centroid_clustering", "op13_source_divergence"])
def test_registered_queries_equal_their_sql(spark, name):
    frame = queries.registered()[name](spark, FOLDER)
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    result = con.execute(queries.statements()[name])
    assert [d[0] for d in result.description] == frame.columns
    found = sorted(map(tuple, frame.collect()))
    assert found and found == sorted(result.fetchall())


# -- lines -----------------------------------------------------------------------

LINES = [
    (5, "A Common Line here\nown line of five\n  a common LINE here\t\nshort\nshort"),
    (2, "a common line here \nown line of two\n\nshort"),
    (9, "x\na common line here"),
    (9, "second row of nine, same id\na common line here\nonly in nine, twice"),
    (9, "only in nine, twice"),
    (7, "ÉTÉ à la plage\nété à la plage\nCAFÉ NOIR ICI\ncafÉ noir ici"),
    (8, "cafÉ noir ici \n été à la plage"),
    (3, None),
    (4, ""),
    (6, "\n\n"),
    (11, "repeated row with text\nanother line in it"),
    (11, "repeated row with text\nanother line in it"),
    (12, "repeated row with text\n123456789\n1234567890"),
    (13, "123456789\n\x0b1234567890\f"),
    (None, "a common line here\nonly without an id\nkept once"),
    (None, "only without an id"),
    (None, None),
    (14, "\n".join(f"line number {k} of many" for k in range(3000))),
    (15, "\n".join(f"line number {k} of many" for k in range(2999, -1, -2)) + "\nline number -1"),
]


def plain_lines(rows):
    def key(line):
        stripped = line.strip(BLANKS)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)

    first = {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for line in (text or "").split("\n"):
            first.setdefault(key(line), doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_frame(spark, rows):
    wide = [(*r, 1, 2, 3, "g", "f") for r in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, h1 int, at int, batch int, gone string, first string")


@pytest.mark.parametrize("batches, hot_keys", [(1, 10_000), (3, 10_000), (4, 1), (7, 3), (60, 0)])
def test_lines_equal_plain_python(spark, batches, hot_keys):
    found = line_dedup.dedup_lines(line_frame(spark, LINES), batches, keep=("first",), hot_keys=hot_keys)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found.collect()), key=repr) == plain_lines(LINES)
    assert found.columns == ["doc_id", "first", "n_lines", "n_dropped", "kept"]


def test_lines_of_a_hot_line_and_of_edge_rows(spark, edge_docs, no_docs):
    rows = [(k, f"the same line everywhere\nown line number {k}") for k in range(400)]
    for hot_keys in (10_000, 10):
        found = line_dedup.dedup_lines(line_frame(spark, rows), hot_keys=hot_keys).collect()
        assert sorted(r.n_dropped for r in found) == [0] + [1] * 399
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    found = line_dedup.dedup_lines(edge_docs).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in found), key=repr) == plain_lines(rows)
    assert line_dedup.digest(line_dedup.dedup_lines(no_docs)).collect() == []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_")]


def test_a_text_of_many_lines_takes_linear_time(spark):
    text = "\n".join(f"line {k} of a very long text" for k in range(200_000))
    docs = line_frame(spark, [(1, text), (2, text + "\none more line of two")])
    found = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert found[1].n_dropped == 0 and found[2].kept == "one more line of two"


def test_runs_stay_levelled_merge_without_loss_and_can_be_opened_again(spark, tmp_path):
    def batch(k):
        rows = [(k * 10 + j, f"line of batch {k} and row {j}\nline in all batches\nline since {max(0, j - k)}!") for j in range(5)]
        return line_frame(spark, rows), rows

    root = str(tmp_path / "runs")
    runs = line_dedup.LineRuns(spark, root, buckets=3)
    everything, found = [], []
    for k in range(6):
        docs, rows = batch(k)
        everything += rows
        found += [(r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_batch(runs, docs).collect()]
        assert all(len(level) <= runs.fanout for level in runs.levels)
        if k == 3:
            # A run that a killed step left is not in the manifest; another session goes on from there.
            runs._write(spark.createDataFrame([(1, 2, 3, 4)], line_dedup._RUN))
            held = runs.runs()
            runs.close()
            runs = line_dedup.LineRuns(spark, root, buckets=8)
            assert runs.runs() == held and runs.buckets == 3
    assert sorted(found, key=repr) == plain_lines(everything)
    keys = [tuple(r) for run in runs.runs() for r in runs._read(run).select("h1", "h2").collect()]
    assert len(keys) == len(set(keys)) == len({x for _, t in everything for x in t.split("\n")})
    assert len(runs.levels) > 2


def test_runs_meet_and_merge_without_a_shuffle(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path / "runs"), buckets=3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        a, b = (
            runs._write(spark.range(k, 1000 + k, 2).selectExpr("id AS h1", "id AS h2", "id AS first", "1L AS n"))
            for k in (0, 1)
        )
        for plan in (runs._merge(runs._read(a), b), runs._read(a).join(runs._read(b), ["h1", "h2"], "left_anti")):
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in text and "Exchange" not in text
            assert plan.count() in (500, 1000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- clusters --------------------------------------------------------------------


def plain_clusters(rows, clusters, rounds, dimensions):
    """Scans everything in every round with Python integers."""
    kept = [
        (i, [int(np.floor(256 * float(np.float64(x)))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)
    ]
    label = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (label(r[0]), r[1]))[:clusters]]
    for n in range(rounds + 1):
        apart = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for _, v in kept]
        nearest = [d.index(min(d)) for d in apart]
        if n == rounds:
            break
        for c in range(len(centroids)):
            mine = [v for (_, v), k in zip(kept, nearest) if k == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    inertia = collections.Counter()
    for d, c in zip(apart, nearest):
        inertia[c] += d[c]
    texts = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, c, d[c], inertia[c], sum(inertia.values()), texts[c]) for (i, _), c, d in zip(kept, nearest, apart)), key=repr
    )


def vector_frame(spark, rows, kind="float"):
    wide = [(i, v, "label", 1, 2) for i, v in rows]
    return spark.createDataFrame(wide, f"vec_id long, embedding array<{kind}>, label string, cluster int, block int").repartition(3)


def clustered(rng, n, dimensions, scale=1.0):
    centres = rng.normal(size=(6, dimensions))
    return [[float(np.float32(x)) for x in (centres[k % 6] + rng.normal(size=dimensions) * 0.4) * scale] for k in range(n)]


@pytest.mark.parametrize("dimensions, scale, kind", [(4, 1.0, "float"), (2, 0.01, "float"), (3, 5e4, "double"), (64, 0.2, "float")])
def test_clusters_equal_plain_python(spark, monkeypatch, dimensions, scale, kind):
    monkeypatch.setattr(centroid_clustering, "BLOCK_BITS", 5)
    rng = np.random.default_rng(dimensions)
    rows = list(enumerate(clustered(rng, 260, dimensions, scale)))
    ones = [0.1 * scale] * dimensions
    # Ties, repeated rows and ids, vectors that have no row.
    rows += [(300, ones), (300, ones), (301, ones), (None, ones), (300, rows[0][1])]
    rows += [(400, None), (401, []), (402, ones[:-1]), (403, [None] + ones[1:]), (404, [float("nan")] + ones[1:])]
    rows += [(405, [float("inf")] + ones[1:]), (406, ones + [1.0])]
    for clusters in (1, 2, 9):
        found = centroid_clustering.cluster_vectors(vector_frame(spark, rows, kind), clusters, 5, dimensions)
        assert sorted(map(tuple, found.collect()), key=repr) == plain_clusters(rows, clusters, 5, dimensions)


def test_clusters_of_few_or_no_vectors(spark):
    few = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 0.0])]
    found = centroid_clustering.cluster_vectors(vector_frame(spark, few), 40, 5, 2).collect()
    assert sorted(map(tuple, found), key=repr) == plain_clusters(few, 40, 5, 2)
    assert centroid_clustering.cluster_vectors(vector_frame(spark, few).limit(0), 40, 5, 2).collect() == []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kmeans")]
    assert centroid_clustering.cluster_vectors(vector_frame(spark, [(1, None)]), 40, 5, 2).collect() == []
    with pytest.raises(ValueError, match="do not fit"):
        centroid_clustering.cluster_vectors(vector_frame(spark, [(1, [1e7, 0.0])]), 40, 5, 2)


def test_later_rounds_scan_only_vectors_whose_gap_expired(monkeypatch):
    scanned = []
    scan = centroid_clustering._scan
    monkeypatch.setattr(centroid_clustering, "_scan", lambda rows, c: (scanned.append(len(rows)), scan(rows, c))[1])
    rng = np.random.default_rng(1)
    matrix = np.floor(np.array(clustered(rng, 2000, 8, 100.0))).astype("<i4")
    centroids = matrix[:6].astype(np.int64)
    batch = pa.RecordBatch.from_pydict({"block": [7], "ids": [list(range(2000))], "vectors": [matrix.tobytes()]})
    drift, state = np.zeros(6), None
    for _ in range(6):
        step = centroid_clustering._assign(centroids, drift, np.float64)
        state = next(step(iter([batch if state is None else pa.RecordBatch.from_arrays(
            [*batch.columns, *state.columns[1:3]], ["block", "ids", "vectors", "heap", "sizes"])])))
        heap, sizes = np.array(state["heap"][0].as_py()), state["sizes"][0].as_py()
        where = np.empty(2000, dtype=int)
        where[heap & ((1 << centroid_clustering.BLOCK_BITS) - 1)] = np.repeat(np.arange(6), sizes)
        apart = ((matrix[:, None, :] - centroids[None]).astype(np.int64) ** 2).sum(2)
        assert (where == apart.argmin(1)).all()
        for segment in np.split(heap, np.cumsum(sizes)[:-1]):
            assert all(segment[(k - 1) // 2] <= segment[k] for k in range(1, len(segment)))
        moved = np.array([matrix[where == c].astype(np.int64).sum(0) // max(1, (where == c).sum()) for c in range(6)])
        drift = drift + centroid_clustering._drifts(centroids, moved)
        centroids = moved
    assert scanned[0] == 2000 and sum(scanned[1:]) < 2000 * 5 / 2


# -- divergence ------------------------------------------------------------------


def plain_divergence(rows, min_docs=10, top=10):
    def terms(text):
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", folded)

    groups, held = {}, {}
    for lang, source, text in rows:
        words = terms(text)
        groups.setdefault((lang or "", source or ""), collections.Counter()).update(words)
        held.setdefault(lang or "", collections.Counter()).update(set(words))
    out = []
    for lang, docs in held.items():
        vocabulary = [t for t, n in docs.items() if n >= min_docs]
        mine = {s: {t: c[t] for t in vocabulary} for (x, s), c in groups.items() if x == lang}
        whole = {t: sum(c[t] for c in mine.values()) for t in vocabulary}

        def parts(counts):
            total = sum(counts.values())
            return {t: 1 + 10**9 * (n + 2) // (total + 2 * len(vocabulary)) for t, n in counts.items()}

        p = {s: parts(c) for s, c in mine.items()}
        q = parts(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in vocabulary)) for o in mine if o != s]
            best = [(t, f(p[s][t], q[t])) for t in vocabulary if mine[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", best)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, t, v, k) for k, (t, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def divergence_frame(spark, rows):
    wide = [(k, *r, 1, "t", 2) for k, r in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id long, lang string, source string, text string, p int, term string, groups int")


@pytest.fixture
def corpus():
    rng = np.random.default_rng(3)
    words = ["Été", "naïve", "日本語", "don't", "a1b", "ÜBER", "über", "Zero", "zero"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    rows = []
    for k in range(400):
        lang = ["en", "de", None, ""][k % 4]
        source = f"s{k % 23}" if k % 3 else "hot"
        low = k % 23
        rows.append((lang, source, " ".join(rng.choice(words[low : low + 60], int(rng.integers(0, 60))))))
    rows += [("en", "empty", ""), ("en", None, None), ("en", "blank", " 12 \x00 .. "), ("alone", "one", "x " * 5)]
    rows += [("few", f"f{k % 3}", f"rare word{chr(97 + k)}") for k in range(6)]
    rows += [("en", "copy", "same words again")] * 12 + [("en", "long", LONG), ("en", "long", PASSAGE)]
    return rows


@pytest.mark.parametrize("group_block, term_block", [(48, 4096), (3, 16), (1, 7)])
def test_divergence_equals_plain_python(spark, monkeypatch, corpus, group_block, term_block):
    monkeypatch.setattr(source_divergence, "GROUP_BLOCK", group_block)
    monkeypatch.setattr(source_divergence, "TERM_BLOCK", term_block)
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 50)
    monkeypatch.setattr(source_divergence, "SEGMENT_BYTES", 16)
    found = source_divergence.audit(divergence_frame(spark, corpus).repartition(5))
    assert sorted(map(tuple, found.collect())) == plain_divergence(corpus)
    assert source_divergence.audit(divergence_frame(spark, corpus).limit(0)).collect() == []


def test_probabilities_of_counts_beyond_a_long_product(spark):
    big = 5 * 10**13
    row = spark.range(1).select(source_divergence.probability(F.lit(big), F.lit(3 * big), F.lit(7)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (3 * big + 14)


def test_a_cell_holds_two_slices(spark, monkeypatch, corpus):
    """However hot a source or language, a cell gets the used terms of two blocks."""
    monkeypatch.setattr(source_divergence, "GROUP_BLOCK", 4)
    monkeypatch.setattr(source_divergence, "TERM_BLOCK", 16)
    rows = stored(divergence_frame(spark, corpus * 3), "corpus")
    cell = source_divergence._cell

    def noted(key, table):
        if table.num_rows > 2 or len(table["entries"].combine_chunks().flatten()) > 2 * 16 * 20:
            raise ValueError("a cell got more than its slices")
        return cell(key, table)

    monkeypatch.setattr(source_divergence, "_cell", noted)
    assert source_divergence.audit(rows).where("part = 'pair'").count() == sum(
        n * (n - 1) for n in collections.Counter(x for x, _ in {(a or "", b or "") for a, b, _ in corpus}).values()
    )
