"""Every operator on nulls, empty and very long texts, repeated rows, clashing columns, and empty tables."""

import pytest


def operators():
    from carestrata.llm import arc, decontam, langid, mixing, pii, quality, records, simhash, suffix, toxicity

    def token_records(docs, **_):
        from carestrata.llm.queries import tokenizer_path

        return records.document_digests(records.read_records(docs.sparkSession, records.write_records(docs, tokenizer_path())))

    def archives(docs, **_):
        spark = docs.sparkSession
        pages = docs.selectExpr("doc_id AS page_id", "source AS url", "text AS html", "key", "n")
        return arc.archive_digests(arc.read_warc(spark, arc.convert_archives(spark, arc.write_arc(pages))))

    return {
        "quality": lambda docs, **_: quality.quality_verdicts(docs),
        "pii": lambda docs, **_: pii.span_digests(pii.find_personal_data(docs)),
        "mixing": lambda docs, **_: mixing.poisson_mix(docs),
        "langid": lambda docs, **_: langid.identify(docs),
        "simhash": lambda docs, **_: simhash.simhash_components(docs),
        "keep_one": lambda docs, **_: simhash.keep_one(docs),
        "suffix": lambda docs, **_: suffix.remove_repeats(docs),
        "records": token_records,
        "arc": archives,
        "toxicity": lambda docs, labels, **_: toxicity.score_documents(docs, labels),
        "reject_toxic": lambda docs, labels, **_: toxicity.reject_toxic(docs, labels),
        "contamination": lambda docs, benchmark, **_: decontam.contamination(docs, benchmark),
        "decontaminate": lambda docs, benchmark, **_: decontam.decontaminate(docs, benchmark),
    }


SAME_ROWS = {"quality", "pii", "langid", "simhash", "suffix", "records", "arc", "toxicity", "contamination"}
SAME_COLUMNS = {"keep_one", "reject_toxic", "decontaminate"}


@pytest.mark.parametrize("name", list(operators()))
def test_edge_rows(name, edge_docs, benchmark, labels):
    out = operators()[name](edge_docs, benchmark=benchmark, labels=labels)
    n = out.count()
    if name in SAME_ROWS:
        assert n == edge_docs.count()
    if name in SAME_COLUMNS:
        assert out.columns == edge_docs.columns and 0 < n <= edge_docs.count()


@pytest.mark.parametrize("name", list(operators()))
def test_empty_table(name, no_docs, benchmark, labels):
    assert operators()[name](no_docs, benchmark=benchmark.limit(0), labels=labels.limit(0)).count() == 0


def test_defined_results(edge_docs, benchmark, labels):
    from carestrata.llm import langid, quality, simhash, toxicity

    by_id = lambda df: {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}
    lang = by_id(langid.identify(edge_docs))
    assert [lang[i]["lang_pred"] for i in (0, 1, 2, 6)] == ["und"] * 4 and lang[0]["score"] == 0
    marks = by_id(quality.quality_verdicts(edge_docs))
    assert marks[0]["n_words"] == 0 and marks[0]["base_failed"] and not marks[0]["kept"]
    assert marks[5]["n_repeat_words"] == 4 and marks[13]["n_dup_lines"] == 0
    prints = by_id(simhash.simhash_components(edge_docs))
    assert prints[0]["fingerprint"] == "0" * 16 and prints[0]["component_id"] == prints[1]["component_id"] == 0
    assert prints[3]["component_id"] == -5  # the same text as document -5
    scores = by_id(toxicity.score_documents(edge_docs, labels))
    assert scores[0]["score"] == scores[1]["score"] == scores[2]["score"]
    assert all(0 <= r["score"] <= 1 for r in scores.values())
