"""The registered queries next to their SQL, and the pipeline next to a plain version."""

import duckdb
import public_tokenizers
import pytest

import brute
import corpus_pipeline
from check import rows_of
from conftest import SF
from depscope.llm import bpe, lines, queries
from depscope.session import store
from test_jaccard import kept_ids

TABLES = ("documents", "benchmark", "conversations", "pages", "labels", "embeddings")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def same_rows(engine, sql, df):
    result = engine.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", list(queries.llm_checks()))
def test_query_equals_sql(llm, engine, name):
    same_rows(engine, queries.llm_checks()[name], queries.llm_queries()[name](llm, SF))


def test_replies_sql_on_quotes(llm):
    from test_pages_and_chats import CHAT
    df = llm.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", CHAT)
    same_rows(con, queries.REPLIES_SQL, queries.quotes.reply_ordered(df))


def test_sql_on_all_white_space(llm):
    """The sample texts hold blanks and line feeds only; words and lines end at other white space, too."""
    blanks, rows = [" ", "\t", "\n", "\x0b", "\f", "\r", "\r\n"], []
    for k in range(140):
        text = blanks[k % 7].join(f"w{(k * j) % 17}" for j in range(6 + k % 40))
        rows.append((k, text + blanks[k % 5] + "#end" * (k % 3) + "\nmenu\r\n\x0b\nmenu\f", "en", f"s{k % 2}"))
    rows += [(200, None, None, None), (201, "", "en", "s0"), (202, " \r\x0b\n\f", "de", None)]
    columns = "doc_id {}, text {}, lang {}, source {}"
    docs = llm.createDataFrame(rows, columns.format("long", *["string"] * 3))
    con = duckdb.connect()
    con.execute(f"create table documents ({columns.format('bigint', *['varchar'] * 3)})")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    same_rows(con, queries.QUALITY_SQL, queries.quality.assess(docs, [docs.doc_id]))
    found = lines.drop_boilerplate(docs).select("doc_id", "source", "n_lines", "n_dropped", "text")
    assert found.where("n_dropped > 0").count() > 100
    same_rows(con, queries.LINES_SQL, found)


@pytest.mark.parametrize("number", range(1, 14))
def test_one_query_for_each_operator(number):
    assert sum(n.startswith(f"op{number}_") for n in queries.llm_queries()) == 1


def test_encoding_stage_is_light(llm):
    """A task of the last stage has one Python worker, which gets small batches."""
    docs = llm.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    found = corpus_pipeline.STAGES[-1][1](llm, docs, SF)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert int(llm.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == corpus_pipeline.BATCH_BYTES
    assert {(r.doc_id, r.n_tokens > 0) for r in found.collect()} == {(1, True), (2, False)}


def plain_pipeline(engine):
    docs = engine.execute("select doc_id, text, source from documents").fetchall()
    kept = {d for d, *rest in engine.execute(f"select doc_id, kept from ({queries.QUALITY_SQL})").fetchall() if rest[0]}
    docs = [r for r in docs if r[0] in kept]
    bad = brute.boilerplate([(t, s) for _, t, s in docs], lines.RATIO_PERMILLE, lines.MIN_PAGES)
    docs = sorted((d, brute.without(t, s, bad)) for d, t, s in docs)
    first = set(kept_ids(docs))  # by the Jaccard similarity of all pairs
    docs = [r for r in docs if r[0] in first]
    leaks = {d for d, _ in brute.leaks(docs, engine.execute("select item_id, text from benchmark").fetchall())}
    return [r for r in docs if r[0] not in leaks]


def test_pipeline(llm, engine):
    docs = plain_pipeline(engine)
    ranks = bpe.load_ranks(public_tokenizers.path(corpus_pipeline.RANK_FILE))
    enc = bpe.encoding(ranks, public_tokenizers.PATTERN)
    got = {r.doc_id: (list(r.ids), r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(llm, SF).collect()}
    assert len(docs) > 100
    assert got == {d: (ids := enc.encode_ordinary(t), len(ids), brute.sha(t.encode())) for d, t in docs}


def test_stages_on_messy_rows(llm, messy):
    rows, plain, wide = messy
    docs = wide
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(llm, docs, SF), "stage")
        assert docs.columns == wide.columns, name
    last = corpus_pipeline.STAGES[-1][1](llm, docs, SF)
    assert last.count() == docs.count() > 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(llm, plain.limit(0), SF).count() == 0, name
        assert stage(llm, plain, SF).count() <= len(rows), name


def test_n_chars_follows_the_text(llm):
    rows = [(k, f"menu\nbody number {k}", "en", "s", 100) for k in range(10)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.line_dedup(llm, docs, SF).collect()
    assert all(r.text == f"body number {r.doc_id}" and r.n_chars == len(r.text) for r in got)
