"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tuneframe.llm.bpe import decode_documents, encode_documents
from tuneframe.llm.counts import count_tokens
from tuneframe.llm.jaccard import jaccard_components
from tuneframe.llm.lz import compare_fingerprints, edit_likeness, fingerprints
from tuneframe.llm.mixing import mixed, mixture
from tuneframe.llm.pii import personal_data
from tuneframe.llm.quality import quality_rules
from tuneframe.llm.substrings import remove_repeated
from tuneframe.llm.suffixes import repeated_passages
from tuneframe.llm.toxicity import Training, toxicity

WORD_FILE, BYTE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch string, key double, run string, head int, row string, language string, n_tokens string, rate string, elements string, label string"
LONG = " ".join(f"word{i % 997}" for i in range(60_000))
BIG = 2**60 + 1  # loses its last digit as a double
ROWS = [(1, "some words here"), (2, None), (3, ""), (4, " \n\t "), (None, "words without a key"), (BIG, LONG), (7, "some words here"), (7, "some words here"), (8, "x")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 1 else "en", None, None, "a", 0.5, "r", 1, "z", None, "t", "u", "e", "l") for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, 0, 1), (8, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "suffixes": lambda d, l: repeated_passages(d),
    "encode": lambda d, l: encode_documents(d, WORD_FILE),
    "encode_digests": lambda d, l: encode_documents(d, WORD_FILE, digests=True),
    "decode": lambda d, l: decode_documents(encode_documents(d, WORD_FILE), WORD_FILE),
    "substrings": lambda d, l: remove_repeated(d),
    "mixture": lambda d, l: mixture(d, l).select("row.doc_id", "n_tokens", "posterior", "rate", "copies"),
    "pii": lambda d, l: personal_data(d),
    "jaccard": lambda d, l: jaccard_components(d),
    "quality": lambda d, l: quality_rules(d),
    "counts": lambda d, l: count_tokens(d, BYTE_FILE),
    "fingerprints": lambda d, l: compare_fingerprints(fingerprints(d), "fingerprint", "fingerprint"),
    "edits": lambda d, l: edit_likeness(d),
    "toxicity": lambda d, l: toxicity(d, l, how=Training(positives=5, negatives=5, epochs=1)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row_with_its_key(docs, labels, name):
    made = OPERATORS[name](docs, labels)
    keys = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in made.select("doc_id").collect())
    assert keys == sorted((i is None, i or 0) for i, _ in ROWS)
    assert made.schema["doc_id"].dataType == docs.schema["doc_id"].dataType


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).count() == 0


def by_key(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_defined_results(docs, labels):
    counts = by_key(count_tokens(docs, BYTE_FILE))
    assert [(counts[i].n_bytes, counts[i].n_tokens, counts[i].over_limit) for i in (2, 3)] == [(0, 0, False)] * 2
    assert counts[BIG].over_limit
    groups = by_key(jaccard_components(docs))
    assert groups[7].component_id == 1 and groups[7].n_links == 2 and groups[1].n_links == 2
    assert [(groups[i].n_shingles, groups[i].component_id) for i in (2, 3, 4)] == [(0, 2), (0, 3), (0, 4)]
    assert groups[None].component_id is None
    rules = by_key(quality_rules(docs))
    assert all(rules[i].base_failed and not rules[i].kept and rules[i].n_words == 0 for i in (2, 3, 4))
    assert by_key(personal_data(docs))[2].spans == ""
    ids = by_key(encode_documents(docs, WORD_FILE))
    assert list(ids[2].ids) == list(ids[4].ids) == []
    edits = by_key(edit_likeness(docs))
    assert edits[3].near_edited == 1.0 and edits[BIG].n_chars == len(LONG)
    scores = by_key(toxicity(docs, labels, how=Training(positives=5, negatives=5, epochs=1)))
    assert all(0 <= r.score <= 1 for r in scores.values()) and not scores[None].held_out


def test_columns_are_kept(docs, labels):
    assert personal_data(docs, redact=True).schema == docs.schema
    assert mixed(docs, labels).columns == docs.columns


def test_text_of_another_name(docs, labels):
    other = docs.select(F.col("doc_id").alias("my id"), F.col("text").alias("my text"))
    assert quality_rules(other, text="my text", key="my id", language=None).count() == len(ROWS)
    assert remove_repeated(other, text="my text", key="my id").count() == len(ROWS)
    assert jaccard_components(other, text="my text", key="my id").count() == len(ROWS)
