from passagemill.llm import tokenizing
from passagemill.llm.token_counts import count_tokens, frequent_pieces, pre_tokens, token_report
from passagemill.llm.tokenizing import PieceCache, open_tokenizer, segments


def library_count(text):
    return len(open_tokenizer("byte_bpe_50k.json").encode(text or "", add_special_tokens=False).ids)


def test_counts_equal_the_library(edge_docs, edge_rows):
    found = count_tokens(edge_docs.select("doc_id", "text")).collect()
    assert len(found) == len(edge_rows)
    for row in found:
        assert row["n_tokens"] == library_count(row["text"])


def test_table_size_changes_no_count(edge_docs):
    counts = [
        sorted((row["doc_id"] or 0, row["n_tokens"]) for row in count_tokens(edge_docs, entries=size).collect())
        for size in (1, 50)
    ]
    assert counts[0] == counts[1]


def test_pieces_are_the_text(edge_rows):
    for _, text in edge_rows:
        parts = pre_tokens(text or "")
        assert parts is None or "".join(piece for part in parts for piece in part) == (text or "")


def test_segments_change_nothing(monkeypatch):
    text = "it's  a \n\n long  line , of words\t and 12 34 more 's"
    whole = [piece for part in pre_tokens(text) for piece in part]
    monkeypatch.setattr(tokenizing, "SEGMENT_CHARS", 3)
    assert len(list(segments(text))) > 3
    assert [piece for part in pre_tokens(text) for piece in part] == whole


def test_full_cache_keeps_results(monkeypatch):
    monkeypatch.setattr(tokenizing, "CACHE_ENTRIES", 4)
    cache = PieceCache()
    for begin in range(0, 40, 3):
        pieces = {str(at) for at in range(begin, begin + 4)}
        cache.fill(pieces, lambda missing: [int(piece) for piece in missing])
        assert all(cache[piece] == int(piece) for piece in pieces)


def test_report_and_empty_table(edge_docs, no_docs):
    report = {row["doc_id"]: row for row in token_report(edge_docs, 512).collect()}
    assert report[4]["n_tokens"] == 0 and report[3]["n_bytes"] == 0
    assert report[8]["over_limit"] and not report[7]["over_limit"]
    assert token_report(no_docs, 512).count() == 0
    assert frequent_pieces(no_docs).count() == 0


def test_no_cache_is_left(spark):
    import pyarrow as pa

    rows = spark.range(0, 40, 1, 8).selectExpr("id as doc_id", "'some words ' || id as text")
    assert count_tokens(rows, entries=1).count() == 40
    assert all(row["n_tokens"] > 0 for row in count_tokens(rows, entries=1).collect())

    def held(batches):
        from passagemill.llm.common import worker_state

        for _ in batches:
            yield pa.RecordBatch.from_pylist([{"n": len(worker_state("cache"))}])

    assert {row["n"] for row in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}
