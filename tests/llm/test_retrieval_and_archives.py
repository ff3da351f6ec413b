"""Packing, vectors, archive derivatives and the pipeline against brute force."""

import base64
import hashlib
import json
import math
import random
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import corpus_pipeline
import numpy as np
import pytest
from comparing import connect, duckdb_rows, spark_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import exact_dedup, langid, packing, queries, secrets, simhash, vectors, warc

FOLDER = "/root/testdata/sf0.001"


# -- packing ----------------------------------------------------------------------------------

def check_pieces(rows, texts, window=4096):
    """``texts``: list of (doc_id, text). Every token once, sequences gapless, at most a little padding."""
    known = Tokenizer.from_file(queries.WORD_VOCABULARY)
    known.encode_special_tokens = True
    ids = [(i, [*known.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in texts]
    expected = Counter((i, len(x)) for i, x in ids)
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    assert by_doc.keys() == expected.keys()
    for (doc, n), pieces in by_doc.items():
        starts = Counter((p.start, p.length) for p in pieces)
        assert sum(p.length for p in pieces) == n * expected[(doc, n)]
        bodies = [x for i, x in ids if i == doc and len(x) == n]
        if len(bodies) == 1:
            at = 0
            for start, length in sorted(starts):
                assert start == at and length > 0
                at += length
            for p in pieces:
                body = np.array(bodies[0][p.start:p.start + p.length], "<u4").tobytes()
                assert p.ids_crc32 == zlib.crc32(body)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
    return sequences


def test_packing_of_documents(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    sequences = check_pieces(queries.QUERIES["op1_bm25_packing"](spark, FOLDER).collect(), texts)
    short = sum(4096 - sum(p.length for p in s) for s in sequences.values())
    assert short < 4096  # one shard: only its last sequence is padded


def test_packing_of_hostile_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "no id"), (3, "long " * 30_000), (4, "same text here"), (5, "same text here"),
            (3, "another text under the id")]
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, start int")
    plan = packing.Packing(window=64, shard_tokens=500, segment=100)
    found = packing.packed(df, queries.WORD_VOCABULARY, 2, plan).withColumn("ids_crc32", F.crc32("ids"))
    check_pieces(found.collect(), rows, 64)
    assert packing.packed(df.limit(0), queries.WORD_VOCABULARY, 2).count() == 0


def test_bm25_scores_and_neighbours():
    draw = random.Random(5)
    segments = [np.array([draw.randrange(30) for _ in range(draw.randint(1, 40))], "<u2") for _ in range(25)]
    plan = packing.Packing(window=50, terms=1000)
    idf = np.array([draw.random() for _ in range(30)])
    mean = 17.0
    index = packing.ShardIndex(segments, idf, mean, plan)
    for seed in range(len(segments)):
        scores = index.scores(seed)
        for other in range(len(segments)):
            if other != seed:
                tf, length = Counter(segments[other].tolist()), len(segments[other])
                plain = sum(idf[t] * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * length / mean)) for t in set(segments[seed].tolist()) if tf[t])
                assert scores[other] == pytest.approx(plain)
    pieces = list(packing.pack_shard(segments, index, plan))
    # A seed's first neighbour is the best unused segment that fits.
    used = set()
    for at, (sequence, offset, segment, start, _) in enumerate(pieces):
        if offset == 0 and start == 0 and at + 1 < len(pieces) and pieces[at + 1][0] == sequence:
            scores = index.scores(segment)
            free = [i for i in range(len(segments)) if i not in used and i != segment]
            room = plan.window - len(segments[segment])
            fitting = [i for i in free if len(segments[i]) <= room]
            if fitting and pieces[at + 1][2] in fitting:
                assert scores[pieces[at + 1][2]] == pytest.approx(max(scores[i] for i in fitting))
        used.add(segment)


# -- vectors ----------------------------------------------------------------------------------

def brute(vectors_by_row):
    """List of (id, vector or None) to rows (id, links, component, kept)."""
    n = len(vectors_by_row)
    fine = [v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in vectors_by_row]
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    unit = [np.array(v, float) / np.abs(v).max() if f else None for (_, v), f in zip(vectors_by_row, fine)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    for a in range(n):
        for b in range(a):
            if fine[a] and fine[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(vectors_by_row):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return Counter((i, links[a], least.get(find(a)), i == least.get(find(a))) for a, (i, _) in enumerate(vectors_by_row))


@pytest.mark.parametrize("plan", [vectors.Plan(), vectors.Plan(cell_rows=8, probes=40, block=5, sureness=8.0)])
def test_vectors_of_hostile_rows(spark, plan):
    draw = np.random.default_rng(6)
    centre = draw.standard_normal(12)
    rows = [(i, (centre + 0.25 * draw.standard_normal(12)).tolist()) for i in range(60)]
    rows += [(100 + i, draw.standard_normal(12).tolist()) for i in range(30)]
    rows += [(200, None), (201, []), (202, [0.0] * 12), (203, [None] + [1.0] * 11), (204, [float("nan")] * 12),
             (205, [float("inf")] + [1.0] * 11), (206, [1e-200, 2e-200]), (207, [1e200, 2e200]), (208, [2.0, 1.0]), (209, [1.0, 2.0])]
    rows += [(None, rows[60][1]), (None, rows[60][1]), (7, rows[61][1]), (7, rows[62][1])] + [(300 + i, rows[0][1]) for i in range(20)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    found = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.vector_groups(df, plan).collect())
    expected = brute(rows)
    fix = lambda c: Counter({(i, n, k, bool(kept)): m for (i, n, k, kept), m in c.items()})
    assert fix(found) == fix(expected)
    assert vectors.vector_groups(df.limit(0)).count() == 0


def test_recall_of_the_index(spark):
    """Links of the given vectors found by the index, against all pairs."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    found = {r.vec_id: r.n_links for r in queries.QUERIES["op7_vector_codes"](spark, "/root/testdata/sf0.1").collect()}
    unit = vectors.units([r.embedding for r in rows])
    links = ((unit @ unit.T) >= 0.9).sum(axis=1) - 1
    assert all(found[r.vec_id] <= n for r, n in zip(rows, links))
    assert sum(found.values()) >= 0.9 * links.sum()


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(8)
    points, queries_ = vectors.units(draw.standard_normal((400, 64))), vectors.units(draw.standard_normal((300, 64)))
    rotation = np.linalg.qr(draw.standard_normal((64, 64)))[0]
    rotated = points @ rotation.T
    codes, factors = [np.packbits(r > 0).tobytes() for r in rotated], np.abs(rotated).sum(axis=1) / 8
    found, bound = vectors.estimates(codes, factors, queries_ @ rotation.T, 3.0)
    error = found - points @ queries_.T
    assert abs(error.mean()) < 2e-3
    assert (np.abs(error) <= bound[:, None]).mean() > 0.99


# -- archives ---------------------------------------------------------------------------------

class Plain(HTMLParser):
    """Text by the standard parser: blocks end lines, hidden elements and the title are left out."""
    BLOCKS = set("p div br h1 h2 h3 h4 h5 h6 li ul ol tr table article section nav header footer main aside body head html "
                 "blockquote pre form hr dd dt dl figure option td th".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript", "template", "title")
        self.parts.append("\n" if tag in self.BLOCKS else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript", "template", "title")
        self.parts.append("\n" if tag in self.BLOCKS else " " if tag in ("script", "style", "title") else "")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data.replace("\n", " ").replace("\r", " "))

    def handle_comment(self, data):
        self.parts.append(" ")


def test_derivatives_of_pages(spark, tmp_path):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = queries.QUERIES["op4_warc_derivatives"](spark, FOLDER).collect()
    assert Counter((r.source_id, r.kind) for r in rows) == Counter((p, k) for p in pages for k in ("metadata", "conversion"))
    label = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    for r in rows:
        page = pages[r.source_id]
        body = page.html.encode()
        message = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
        assert r.source_block_digest == label(message) and r.source_payload_digest == label(body)
        assert r.block_digest == label(r.block.encode()) and r.content_length == len(r.block.encode())
        assert r.target_uri == page.url and r.refers_to.startswith("<urn:uuid:") and r.record_id != r.refers_to
        if r.kind == "conversion":
            parser = Plain()
            parser.feed(page.html)
            parser.close()
            assert "".join(r.block.split()) == "".join("".join(parser.parts).split())
        else:
            told = json.loads(r.block)
            assert told["headers"] == [["Content-Type", "text/html; charset=utf-8"], ["Content-Length", str(len(body))]]
            assert told["refers_to"] == r.refers_to and told["payload_digest"] == label(body)
    assert len({r.record_id for r in rows}) == len(rows)
    assert len({r.refers_to for r in rows}) == len(pages)
    written = warc.write_records(queries.QUERIES["op4_warc_derivatives"](spark, FOLDER), f"file://{tmp_path}/warc").collect()
    assert sum(r.n_records for r in written) == len(rows)
    back = warc.read_records(spark, f"file://{tmp_path}/warc").collect()
    assert Counter((r.record_id, r.refers_to, r.block_digest, r.block) for r in back) == Counter(
        (r.record_id, r.refers_to, r.block_digest, r.block) for r in rows)


def test_derivatives_of_hostile_responses(spark):
    rows = [(1, "<urn:a>", "u", "d", None), (None, None, None, None, b"no blank line"), (2, "<urn:b>", "u", "d", b"HTTP/1.1 404\r\nX: 1\r\nX:2\r\n\r\n<p>a&lt;b<b>c</b>"),
            (2, "<urn:b>", "u", "d", b"HTTP/1.1 404\r\nX: 1\r\nX:2\r\n\r\n<p>a&lt;b<b>c</b>"), (3, "<urn:c>", "u", "d", b"\r\n\r\n\xff<br>" + b"x " * 50_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows],
                               "source_id long, record_id string, target_uri string, date string, message binary, block string")
    found = defaultdict(list)
    for r in warc.derivatives(df).collect():
        found[(r.source_id, r.kind)].append(r.block)
    assert found[(1, "conversion")] == [""] and found[(None, "conversion")] == ["no blank line"]
    assert found[(2, "conversion")] == ["a<bc"] * 2
    assert json.loads(found[(2, "metadata")][0])["headers"] == [["X", "1"], ["X", "2"]]
    assert found[(3, "conversion")][0].split("\n")[0] == "�"
    assert warc.derivatives(df.limit(0)).count() == 0


# -- queries with SQL, pipeline -----------------------------------------------------------------

@pytest.mark.parametrize("name", list(queries.EXPECTED))
def test_query_against_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, FOLDER)) == duckdb_rows(connect(FOLDER), queries.EXPECTED[name])


def stages_one_by_one(spark, docs):
    """The pipeline's decisions recomputed row by row, each stage with the plain form of its rule."""
    model = langid.train(docs)
    kept = [r for r in langid.identify(docs, model).collect() if r.lang_accepted]
    texts = {}
    for r in sorted(kept, key=lambda r: r.doc_id):
        texts.setdefault(exact_dedup.one_space((r.text or "").encode()), r)
    kept = list(texts.values())
    prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) & (1 << 64) - 1 for r in kept}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if b >= a:
                break
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [r for r in kept if find(r.doc_id) == r.doc_id]


def test_pipeline(spark, tmp_path):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    told = given.where("lang = 'en' and n_chars > 500").orderBy("doc_id").limit(3)
    planted = told.select((F.col("doc_id") + 10_000).alias("doc_id"), F.concat("text", F.lit(" password = hunter2222 end")).alias("text"),
                          "lang", "source", "n_chars")
    given.unionByName(planted).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = stages_one_by_one(spark, docs)
    stage = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        stage = spark.createDataFrame(function(spark, stage, str(tmp_path)).collect(), docs.schema)
        assert stage.columns == docs.columns
    rows = {r.doc_id: r for r in stage.collect()}
    assert rows.keys() == {r.doc_id for r in kept}
    marked = [r for r in kept if (rows[r.doc_id].text != r.text)]
    assert marked and all("[secret]" in rows[r.doc_id].text for r in marked)
    assert all(r.n_chars == len(r.text) for r in rows.values())
    check_pieces(corpus_pipeline.run(spark, str(tmp_path)).collect(), [(i, r.text) for i, r in rows.items()])


def test_stages_on_hostile_rows(spark):
    """Nulls, repeated rows and ids, and no rows at all, in every stage."""
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    rows = [(1, "the same text for two", "en", "a", 5), (1, "the same text for two", "en", "a", 5), (2, "the  same text for two", "en", "a", 5),
            (None, "the same text for two", None, None, None), (None, "a text of its own", "en", None, 1), (3, None, None, None, None),
            (4, "", "en", "b", 0), (1, "same id, another text", "en", "b", 0), (5, "password=hunter2222", "en", "c", 1)]
    df, nothing = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, FOLDER).count() == 0
        stage(spark, df, FOLDER).collect()
    exact = Counter((r.doc_id, r.text) for r in corpus_pipeline.exact_copies(spark, df, FOLDER).collect())
    assert exact == Counter({(1, "the same text for two"): 1, (None, "a text of its own"): 1, (3, None): 1,
                             (1, "same id, another text"): 1, (5, "password=hunter2222"): 1})
    near = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, df, FOLDER).collect())
    assert (None, "the same text for two") not in near and (None, "a text of its own") in near and (2, "the  same text for two") not in near
    clean = {r.doc_id: r for r in corpus_pipeline.secret_scan(spark, df, FOLDER).collect()}
    assert clean[5].text == "[secret]" and clean[5].n_chars == 8 and clean[3].text is None
