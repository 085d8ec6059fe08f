import hashlib
import random
import re

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quotemill.llm import fill_middle, piece_codec, queries, turn_repair
from tests.llm.fixtures import ODD, clashing, documents
from tests.llm.plain_turns import plain_damage, plain_repair

FOLDER = "/root/testdata/sf0.001"
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def by_conversation(df):
    return {x[0]: tuple(x)[1:] for x in df.collect()}


def wanted(df):
    rows = [tuple(x) for x in df.select("conv_id", "turn", "role", "text").collect()]
    return {c: plain_repair(v) for c, v in plain_damage(rows).items()}


# Operator 11


def test_query_equals_shortest_paths(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert by_conversation(queries.op11_turn_alignment(spark, "/root/testdata/sf0.01")) == wanted(rows)


def odd_turns(spark):
    r = random.Random(3)
    rows = [(r.choice([None, 1, 2, 3]), r.choice([None, 0, 1, 2, 3, 4, 9]), r.choice([None, "user", "assistant", "system", "tool", ""]), r.choice([None, "", "a.", "b", " é!", "c? "])) for _ in range(300)]
    return spark.createDataFrame(rows, CONVERSATIONS).repartition(5)


@pytest.mark.parametrize("short, piece", [(256, 64), (2, 7), (2, 1), (0, 64)])
def test_nulls_ties_and_repeats_in_pieces_of_any_size(spark, short, piece):
    rows = odd_turns(spark)
    assert by_conversation(turn_repair.repair_conversations(turn_repair.damage(rows), short, piece)) == wanted(rows)


def test_one_long_conversation_over_many_tasks(spark):
    r = random.Random(4)
    rows = [(7, t, r.choice(["user", "assistant"]) if r.random() < 0.2 else ("user", "assistant")[t % 2], r.choice(["yes.", "no", "", f"text {t}."])) for t in range(1500)]
    df = spark.createDataFrame([*rows, (8, 0, "user", "a.")], CONVERSATIONS).repartition(7)
    assert by_conversation(turn_repair.repair_conversations(turn_repair.damage(df))) == wanted(df)


def test_repaired_turns_are_the_text_behind_the_digest(spark):
    damaged = turn_repair.damage(odd_turns(spark))
    for short in (256, 2):
        turns = {}
        for x in turn_repair.repaired_turns(damaged, short, 5).orderBy("conv_id", "position").collect():
            turns.setdefault(x["conv_id"], []).append(f"{x['role']}:{x['text']}")
        for conv, row in by_conversation(turn_repair.repair_conversations(damaged)).items():
            assert hashlib.sha256("\n".join(turns.get(conv, [])).encode()).hexdigest() == row[-1]


def test_no_conversations_and_other_columns(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert turn_repair.repair_conversations(turn_repair.damage(empty)).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "a.", "x", True)], CONVERSATIONS + ", said string, first boolean")
    assert by_conversation(turn_repair.repair_conversations(turn_repair.damage(rows), short=0)) == wanted(rows)
    # Every row dropped: the conversation stays, with zeros.
    gone = spark.createDataFrame([(5, 1, "user", "a.", True)], CONVERSATIONS + ", dropped boolean")
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for short in (256, 0):
        assert by_conversation(turn_repair.repair_conversations(gone, short)) == {5: none}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suat"), st.booleans(), st.sampled_from([0, 1])), max_size=8))
def test_pieces_put_together_cost_as_the_whole(turns):
    whole = turn_repair.repair(turns)
    for k in range(len(turns) + 1):
        options = [(x[0] + y[0], x[1] + y[1]) for s in turn_repair.STATES for e in (0, 3)
                   if (x := turn_repair.repair(turns[:k], 0, (s,))) and (y := turn_repair.repair(turns[k:], s, (e,)))]
        assert min(options) == whole


# Operator 12

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_cut(doc_id, text):
    text, units = text or "", UNITS.findall(text or "")
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k: 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return (doc_id, len(units), "plain", None, None, text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    return (doc_id, len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}")


def test_every_form_equals_plain_cuts(spark):
    texts = ["", " ", "\n\na", "a ", " é 漢 ", "a <P> b", "x\x0b\x0cy z ", "😀 b c d", None, "one", "a  b\tc\r\n"]
    rows = [(i, texts[i % len(texts)], None, None, None) for i in range(-200, 200)] + ODD
    out = fill_middle.transform(clashing(documents(spark, rows)).drop("n"))
    got = sorted(((x["doc_id"], x["n"], x["form"], x["prefix_chars"], x["middle_chars"], x["fim_text"]) for x in out.collect()), key=repr)
    assert got == sorted((plain_cut(r[0], r[1]) for r in rows), key=repr)
    assert {x[2] for x in got} == {"plain", "spm", "psm"}


def test_whole_texts_come_back(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    back = fill_middle.restore(fill_middle.transform(docs))
    assert back.filter("NOT restored_text <=> coalesce(text, '')").count() == 0 and back.filter("form <> 'plain'").count() > 50


def test_damaged_output_gives_null_and_empty_table_none(spark):
    bad = spark.createDataFrame([("<P>a<S>b", "psm"), (None, "plain"), ("x", None)], "fim_text string, form string")
    assert [x["restored_text"] for x in fill_middle.restore(bad).collect()] == [None] * 3
    assert fill_middle.digests(documents(spark).limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=300))
def test_every_rank_is_found(widths):
    import numpy as np

    units = fill_middle.SkipList(np.array(widths, np.int64))
    assert [units.place(k) for k in range(len(widths) + 1)] == [sum(widths[:k]) for k in range(len(widths) + 1)]
    with pytest.raises(IndexError):
        units.place(len(widths) + 1)


# Operator 13


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_codec.default_model())


def test_whole_documents_equal_the_library(spark, library):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op13_piece_backtracking(spark, folder).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


SYLLABLES = ["a", "b", "e", "th", "the", " ", "  ", "▁", "é", "漢", "\n", "\0", "1", "00", "ing", "er", "😀", ".", " the", " " * 20, "aaaa", "===", "--", "ﬁ", "<s>", "<0x41>"]


@settings(max_examples=2000, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(SYLLABLES), max_size=20).map("".join), st.text(st.characters(exclude_categories=["Cs"]), max_size=30)))
def test_any_text_equals_the_library(library, text):
    c = piece_codec.codec(piece_codec.default_model())
    ids = library.encode(text)
    assert c.encode(text) == ids and c.decode(ids) == library.decode(ids)


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 3, 65, 200, 230, 259, 2287, 28705]), st.integers(0, 31999)), max_size=8))
def test_any_ids_are_read_as_by_the_library(library, ids):
    assert piece_codec.codec(piece_codec.default_model()).decode(ids) == library.decode(ids)


def test_long_stretches_equal_the_library(library):
    c = piece_codec.codec(piece_codec.default_model())
    for text in ("ab" * 30_000, "étth" * 20_000, " " * 5001, "x=" * 999, "".join(random.Random(1).choices("abcdeth", k=50_000))):
        assert c.encode(text) == library.encode(text)


def test_odd_rows_and_clashing_names(spark, library):
    out = piece_codec.encode_documents(clashing(documents(spark)), with_ids=True)
    got = sorted(((x["doc_id"], tuple(x["ids"]), x["score"]) for x in out.collect()), key=repr)
    assert got == sorted(((r[0], tuple(library.encode(r[1] or "")), "own") for r in ODD), key=repr)
    texts = sorted((x["doc_id"] or 0, x["text"]) for x in piece_codec.decode_documents(out).collect())
    assert texts == sorted((r[0] or 0, r[1] or "") for r in ODD)
    assert piece_codec.encode_documents(documents(spark).limit(0)).count() == 0
