import numpy as np
import pyarrow as pa
import pytest

from passagemill.llm import packing
from passagemill.llm.packing import pack, piece_report, sequences
from passagemill.llm.tokenizing import PieceCache, encode_pieces, open_tokenizer

NAME = "word_bpe_49k.json"


def library_ids(text):
    ids = open_tokenizer(NAME).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 2], dtype="<u4").tobytes()


@pytest.mark.parametrize("window", [16, 4096])
def test_pieces_are_the_documents(edge_docs, edge_rows, window):
    if window == 16:
        edge_docs = edge_docs.where("length(text) < 1000 or text is null")
        edge_rows = [row for row in edge_rows if row[1] is None or len(row[1]) < 1000]
    pieces = pack(edge_docs, window=window).collect()
    # the rows' pieces, put together by their place in the stream
    stream = sorted(pieces, key=lambda row: (row["sequence_id"], row["offset"]))
    end = 0
    whole = []
    for row in stream:
        assert row["sequence_id"] * window + row["offset"] == end
        assert row["offset"] + row["length"] <= window and len(row["ids"]) == 4 * row["length"]
        if row["start"] == 0:
            whole.append(b"")
        whole[-1] += row["ids"]
        end += row["length"]
        if row["start"] + row["length"] == row["doc_tokens"]:
            assert len(whole[-1]) == 4 * row["doc_tokens"]
    assert sorted(whole) == sorted(library_ids(text) for _, text in edge_rows)


def test_sequences_are_full_but_the_last(edge_docs):
    found = sorted(sequences(pack(edge_docs)).collect(), key=lambda row: row["sequence_id"])
    assert [row["sequence_id"] for row in found] == list(range(len(found)))
    assert all(row["length"] == 4096 for row in found[:-1])
    assert all(len(row["ids"]) == 4 * row["length"] for row in found)
    assert all(row["boundaries"][0]["offset"] == 0 for row in found)


def test_words_alone_have_the_ids_of_the_library(edge_rows):
    words = sorted({word for _, text in edge_rows for word in (text or "").encode().split()})
    words = [word.decode() for word in words]
    found = open_tokenizer(NAME).encode_batch(words, add_special_tokens=False)
    assert encode_pieces(words, NAME) == [one.ids for one in found]


def test_empty_table(no_docs):
    assert piece_report(pack(no_docs)).count() == 0


def test_ids_are_handed_on_by_their_running_size(spark):
    """Many rows of 100 KB go out in several batches, and every id is there."""
    text = " ".join(f"word{at % 977}" for at in range(12_000))
    rows = [(key, text) for key in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    stream = packing.token_stream(docs)
    held = stream.selectExpr("max(length(ids)) one", "sum(n_ids) all", "max(begin + n_ids) last").first()
    assert held["all"] == held["last"] and held["one"] * 60 == 4 * held["all"]


def test_long_pieces_are_not_cached():
    cache = PieceCache()
    long, asked = "y" * 1_000, []

    def encode(pieces):
        asked.extend(pieces)
        return [len(piece) for piece in pieces]

    for _ in range(2):
        cache.fill({"a", long}, encode)
        assert cache["a"] == 1 and cache[long] == 1_000
    assert set(cache) == {"a"} and asked.count(long) == 2 and asked.count("a") == 1
    cache.fill({"b"}, encode)
    assert long not in cache.long


def test_workers_take_few_documents_at_once(spark, monkeypatch):
    asked = []
    true = packing.arrow_batch_rows
    monkeypatch.setattr(packing, "arrow_batch_rows", lambda s, rows: asked.append(rows) or true(s, rows))
    monkeypatch.setattr(packing, "BATCH_ROWS", 7)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 20, 1, 1).selectExpr("id as doc_id", "'one two' as text")
    pieces = pack(docs)
    assert asked == [7] and spark.conf.get(key) == before
    assert pieces.count() == 20


def test_pieces_of_a_run_are_encoded_once(monkeypatch):
    """A stem is encoded once, whatever its case and the signs behind it."""
    asked = []
    true = packing.packed_ids
    monkeypatch.setattr(packing, "packed_ids", lambda pieces, name: asked.extend(pieces) or true(pieces, name))
    texts = ["Grölwhy, grölwhy. GRÖLWHY!" * 5, None, "", " grölwhy\x0b\x1cgrölwhy\x85 ", "grölwhy, " * 1_000]
    found = [one for ids in packing.encode_texts(pa.array(texts), NAME, 2) for one in ids.to_pylist()]
    assert found == [library_ids(text) for text in texts]
    assert len(asked) == len(set(asked)) and asked.count("grölwhy") == 1 and "GRÖLWHY" not in asked


def test_runs_end_with_their_bytes(monkeypatch):
    monkeypatch.setattr(packing, "RUN_BYTES", 10)
    texts = ["one two three", "a", "b", "four five six seven", "", None, "c"]
    runs = [ids.to_pylist() for ids in packing.encode_texts(pa.array(texts), NAME, 2)]
    assert [one for ids in runs for one in ids] == [library_ids(text) for text in texts]
    assert len(runs) > 2 and list(packing.encode_texts(pa.array([], pa.string()), NAME, 2)) == []


def test_odd_words_have_the_ids_of_the_library():
    odd = "J̌ ǰ İ İ Å Å ß ẞ ÿ Ÿ ª µ × a× don't x'll '' ## a#b #a a1 1 ½ ﬁ Ω ΑΣ <|endoftext|> a<|endoftext|> <|ENDOFTEXT|>"
    texts = [odd, *odd.split(), odd.upper(), "a­b", "x" * 70, "éè" * 40 + "..", "\x00 \x01a", "日本語 한국"]
    found = [one for ids in packing.encode_texts(pa.array(texts), NAME, 2) for one in ids.to_pylist()]
    assert found == [library_ids(text) for text in texts]


def test_workers_keep_no_cache_behind_a_task(spark):
    pack(spark.range(0, 40, 1, 4).selectExpr("id as doc_id", "'one two ' || id as text")).count()

    def held(batches):
        from passagemill.llm.common import worker_state

        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"n": len(worker_state("cache"))}])

    assert {row["n"] for row in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}


def test_stems_go_to_the_library_in_bounded_calls(monkeypatch):
    from passagemill.llm import tokenizing

    monkeypatch.setattr(tokenizing, "STEMS_AT_ONCE", 3)
    words = ["one", "two", "three", "fölks", "qzxvkj", "seven", "eight"]
    assert tokenizing.packed_ids(words, NAME) == [library_ids(word)[:-4] for word in words]
