"""The registered queries on small tables: names, types, a row for each document or page."""

from __future__ import annotations

import zlib

import pytest

import reference as R
from lumenframe.llm import queries as Q

# The columns that each query returns.
COLUMNS = {
    "op1_mix_sources": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op2_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op3_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op5_pack_sequences": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op7_url_rules": "page_id bigint, host string, path string, rule string, verdict string",
    "op8_ngram_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op9_license_scan": "doc_id bigint, n_licences bigint, licences string",
    "op10_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
}


@pytest.fixture(scope="module")
def sf_dir(spark, docs, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    pages = [(1, "http://Example.org/es/a", "<nav>Menu</nav><article><p>One</p></article>"), (2, "http://example.org/b?x", "<p>Menu</p><p>Two</p>"), (3, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{at}/pages.parquet")
    return at


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, sf_dir, texts, name):
    out = Q.QUERIES[name](spark, sf_dir)
    kinds = dict(out.dtypes)
    for column in COLUMNS[name].split(", "):
        n, kind = column.split(" ")
        assert kinds[n] == kind, (name, n)
    rows = out.collect()
    if name == "op5_pack_sequences":
        assert {r.doc_id for r in rows} == {i for i, _ in texts}
    else:
        assert len(rows) == (3 if "page_id" in kinds else len(texts))
    if name == "op3_language_id":
        for r in rows:
            assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert 0 <= r.score <= 1
    if name == "op10_quality":
        words = {i: len(R.words(t)) for i, t in texts}
        assert all(r.n_words == words[r.doc_id] for r in rows if r.doc_id != 7)
        assert not any(r.kept and r.base_failed for r in rows)
    if name == "op7_url_rules":
        assert sorted((r.page_id, r.host, r.rule, r.verdict) for r in rows)[0] == (1, "example.org", "example.org/es/", "block")
