"""The registered queries on the smallest tables: contract columns and types, whole tables, and
SQL or the contract's definitions where they can be stated."""

import hashlib
import re

import duckdb
import pytest

import __spark_entry__ as E
from voltaic.llm.oracle import SQL
from voltaic.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .test_licenses import brute as brute_license
from .test_pii import brute as brute_pii
from .test_quality import brute as brute_quality
from .test_secrets import brute as brute_secrets
from .test_simhash import brute_components, brute_fp

CONTRACT = {
    "op1": "doc_id bigint,n_words bigint,n_hit bigint,n_items bigint,items_sha256 string,contaminated boolean",
    "op2": "conv_id bigint,n_turns bigint,turns_sha256 string,loss_chars bigint,loss_sha256 string,formatted_chars bigint",
    "op3": "doc_id bigint,held_out boolean,score double,predicted int",
    "op4": "doc_id bigint,n_words bigint,n_base bigint,first_word bigint,last_word bigint,base_labels string,labels string,score double",
    "op5": "page_id bigint,host string,path string,rule string,verdict string",
    "op6": "doc_id bigint,n_words bigint,word_chars bigint,n_symbols bigint,n_dup_lines bigint,n_repeat_words bigint,base_failed boolean,kept boolean",
    "op7": "doc_id bigint,n_assign bigint,n_access bigint,n_hex bigint,base_sha256 string,spans string",
    "op8": "doc_id bigint,fingerprint string,component_id bigint",
    "op9": "doc_id bigint,n_email bigint,n_ip bigint,n_card bigint,n_phone bigint,base_sha256 string,spans string",
    "op10": "doc_id bigint,piece int,start bigint,length bigint,ids_crc32 bigint,sequence_id bigint,offset bigint",
    "op11": "doc_id bigint,n bigint,form string,prefix_chars bigint,middle_chars bigint,output_sha256 string,restored_sha256 string",
    "op12": "vec_id bigint,code string,error bigint,label_error bigint,codebooks_sha256 string",
    "op13": "doc_id bigint,n_lines bigint,n_dropped bigint,kept_sha256 string",
}
CON = duckdb.connect()
for t in ("documents", "benchmark", "conversations", "pages", "labels", "embeddings"):
    CON.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
TEXTS = dict(CON.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture(scope="module")
def results(spark):
    out = {}
    for name, q in QUERIES.items():
        df = q(spark, SF_SMALL)
        out[name.split("_")[0]] = (dict(df.dtypes), df.toPandas())
    return out


def test_all_are_registered():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(CONTRACT)
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("op", sorted(CONTRACT))
def test_contract_columns(results, op):
    types, df = results[op]
    assert {c: types.get(c) for c in (x.split()[0] for x in CONTRACT[op].split(","))} == dict(x.split() for x in CONTRACT[op].split(","))
    table = {"op2": "conversations", "op5": "pages", "op12": "embeddings"}.get(op, "documents")
    if op == "op2":
        assert len(df) == CON.execute("SELECT count(DISTINCT conv_id) + 1 FROM conversations").fetchone()[0]
    elif op != "op10":
        assert len(df) == CON.execute(f"SELECT count(*) FROM {table}").fetchone()[0]


@pytest.mark.parametrize("key", sorted(SQL))
def test_sql_agrees(results, key):
    want = CON.execute(SQL[key]).df()
    got = results[key.split("_")[0]][1][list(want.columns)].astype(want.dtypes.to_dict())
    rows = lambda d: sorted(map(repr, d.astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def named(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def test_definitions(results):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    by = {op: results[op][1].set_index("doc_id") for op in ("op4", "op6", "op7", "op9", "op8")}
    fps, roots = [brute_fp(t) for t in TEXTS.values()], None
    roots = brute_components(fps, 4)
    least = {}
    for d, r in zip(TEXTS, roots):
        least[r] = min(least.get(r, d), d)
    for d, fp, r in zip(TEXTS, fps, roots):
        t = TEXTS[d]
        assert by["op8"].loc[d].tolist()[:2] == [f"{fp:016x}", least[r]]
        q = by["op6"].loc[d]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute_quality(t)
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words) and not (q.base_failed and q.kept)
        x = brute_license(t)
        q = by["op4"].loc[d]
        assert (q.n_words, q.n_base, q.base_labels) == (x[0], x[1], ",".join(x[4])) and (not x[1] or (q.first_word, q.last_word) == x[2:4])
        assert set(x[4]) <= set(filter(None, q.labels.split(",")))
        for op, brute, kinds in (("op7", brute_secrets, ("assign", "access", "hex")), ("op9", brute_pii, ("email", "ip", "card", "phone"))):
            q, spans = by[op].loc[d], brute(t)
            assert q.base_sha256 == sha(named(spans, kinds))
            assert [q[f"n_{k}"] for k in kinds] == [sum(s[1] == n for s in spans) for n in range(len(kinds))]
            every = q.spans.split(",") if q.spans else []
            assert set(filter(None, named(spans, kinds).split(","))) <= set(every)
            starts = [int(re.split(":", s)[1]) for s in every]
            assert starts == sorted(starts)


def test_scores_depend_on_the_text_alone(results):
    df = results["op3"][1].assign(text=lambda d: d.doc_id.map(TEXTS))
    assert (df.groupby("text").score.nunique() == 1).all()
    assert ((df.score >= 0.3).astype(int) == df.predicted).all() and df.score.between(0, 1).all()
