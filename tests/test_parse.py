"""Golden frames, tuples, and properties of the parser."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions.frames import frame_bytes
from tidelog.operators import parse
from tidelog.operators.parse import errors, first_frame, parse_chunks, records
from tidelog.operators.tuples import decode_tuple, json_value
from tidelog.schema import NO_TERMINATOR, OPERATIONS, SHORT_FRAME

MAX = 2**64 - 1


def plain_frames(chunk):
    """Records of a chunk, byte by byte, or the name of its error."""
    out, at, end = [], 0, len(chunk)
    number = int.from_bytes
    while end - at >= 4:
        code = chr(chunk[at])
        if code == "B":
            at += 5
            continue
        if code not in "WIUDT":
            break
        if at + 25 > end:
            return SHORT_FRAME
        first = chunk.find(0, at + 25)
        second = chunk.find(0, first + 1) if first >= 0 else -1
        if second < 0:
            return NO_TERMINATOR
        after = second + 1
        if code != "W":
            names = [chunk[at + 25 : first].decode("utf-8", "replace"), chunk[first + 1 : second].decode("utf-8", "replace")]
            oid = number(chunk[after : after + 4]) if end - after > 4 else 0
            out.append((OPERATIONS[code], number(chunk[at + 1 : at + 9]), number(chunk[at + 9 : at + 17]), number(chunk[at + 17 : at + 25], signed=True), *names, oid))
        at = after
    return out


#: name: chunk, then records (operation, lsn, xid, time, schema, table, oid) or the error.
GOLDEN = {
    "G01": ("490000000000000018000000000000000700000000000003e87075626c6963006f7264657273000000400078", [("Insert", 24, 7, 1000, "public", "orders", 16384)]),
    "G02": ("550000000000000018000000000000000700000000000003e87075626c6963006f72646572730000004000", [("Update", 24, 7, 1000, "public", "orders", 0)]),
    "G03": ("490000000000000001000000000000000700000000000003e873007400550000000000000002000000000000000700000000000003e873007400", [("Insert", 1, 7, 1000, "s", "t", 0x55000000), ("Update", 2, 7, 1000, "s", "t", 0)]),
    "G04": ("570000000000000001000000000000000700000000000003e873007400", []),
    "G05": ("42000000004400000000000000090000000000000008000000000000000073007400", [("Delete", 9, 8, 0, "s", "t", 0)]),
    "G06": ("6b49494949494949494949494949494949494949494949494949494949494949494949494949494949", []),
    "G07": ("490000", []),
    "G08": ("49000000000000000100000000000000010000000000000001", NO_TERMINATOR),
    "G09": ("54000000000000000100000000000000010000000000000001730074", NO_TERMINATOR),
    "G10": ("490000000000000001000000000000000700000000000003e87300740055010101010101010101010101010101010101010101010101616263", NO_TERMINATOR),
    "G11": ("44010101010101010101", SHORT_FRAME),
    "G12": ("49000000000000000100000000000000010000000000000001707562ff6ce282007400", [("Insert", 1, 1, 1, "pub�l�", "t", 0)]),
    "G13": ("49fffffffffffffffffffffffffffffffffffffffffffffffb73007400", [("Insert", MAX, MAX, -5, "s", "t", 0)]),
    "G14": ("490000000000000001000000000000000100000000000000010000", [("Insert", 1, 1, 1, "", "", 0)]),
    "G15": ("49000000000000000100000000000000010000000000000001730074004900000078", SHORT_FRAME),
    "G16": ("", []),
    "G17": ("42000000", []),
    "G18": ("49000000000000000100000000000000010000000000000001730074004200000000", [("Insert", 1, 1, 1, "s", "t", 0x42000000)]),
}


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(i, bytearray.fromhex(x)) for i, (x, _) in enumerate(GOLDEN.values())] + [(99, None)]
    return spark.createDataFrame(rows, "seq long, chunk binary")


def _expected(first_only=False):
    out = {}
    for i, (_, want) in enumerate(GOLDEN.values()):
        if isinstance(want, str):
            out[i] = want
        elif want:
            out[i] = want[:1] if first_only else want
    return out


def _found(parsed):
    out = {}
    for r in parsed.orderBy("seq", "idx").collect():
        assert r.new_tuple is None and r.old_tuple is None
        if r.error:
            assert r.seq not in out and r.lsn is None and r.operation is None
            out[r.seq] = r.error
        else:
            out.setdefault(r.seq, []).append((r.operation, int(r.lsn), int(r.tx_xid), r.tx_commit_time, r.table_schema, r.table_name, r.oid))
            assert r.idx == len(out[r.seq]) - 1
    return out


def test_golden_frames(golden):
    assert _found(parse_chunks(golden)) == _expected()
    assert {i: w if isinstance(w, str) else list(w) for i, w in _expected().items()} == {i: w for i, (x, _) in enumerate(GOLDEN.values()) if (w := plain_frames(bytes.fromhex(x)))}


def test_outcomes_count_every_chunk(golden):
    rows = parse_chunks(golden.withColumn("twice", F.col("seq") * 2), keep=["twice"], outcomes=True).collect()
    assert {r.seq for r in rows} == {*range(len(GOLDEN)), 99} and all(r.twice == 2 * r.seq for r in rows)
    assert sorted(r.seq for r in rows if not r.idx) == sorted({r.seq for r in rows})
    want = _expected()
    assert {r.seq for r in rows if r.idx is None} == {r.seq for r in rows} - set(want)


def test_first_frame(golden):
    """The native path sees first frames only: voided later ones and skipped heads are not its concern."""
    names, found = list(GOLDEN), _found(first_frame(golden))
    want = {i: w for i, w in _expected(first_only=True).items() if names[i] not in ("G05", "G10", "G15")}
    assert {i: w for i, w in found.items() if names[i] not in ("G10", "G15")} == want


def test_errors_keep_the_chunk(golden):
    rows = errors(parse_chunks(golden), golden).collect()
    names = list(GOLDEN)
    assert {names[r.seq]: r.error for r in rows} == {n: w for n, (_, w) in GOLDEN.items() if isinstance(w, str)}
    assert all(bytes(r.chunk).hex() == GOLDEN[names[r.seq]][0] for r in rows)
    assert records(parse_chunks(golden)).where("error is not null").count() == 0


def test_tuples(spark):
    cases = [
        ("T1", [23], "4e", [None]), ("T2", [23, 25], "4e4e", [None, None]), ("T3", [23, 25], "740102", [b"\1\2", None]), ("T4", [23, 25], "4e7441", [None, b"A"]),
        ("T5", [], "7441", []), ("T6", [23], "", [None]), ("T7", [25], "74", [b""]), ("T8", [23, 25], "6e74", [b"t", None]), ("T9", [23], None, [None]),
    ]
    df = spark.createDataFrame([(c, o, None if d is None else bytearray.fromhex(d)) for c, o, d, _ in cases], "c string, o array<bigint>, d binary")
    got = {r.c: r for r in df.select("c", decode_tuple(F.col("d"), F.col("o")).alias("t"), F.transform(decode_tuple(F.col("d"), F.col("o"))["columns"], lambda x: json_value(x["value"])).alias("j")).collect()}
    for name, oids, _, want in cases:
        columns = got[name].t["columns"]
        assert [(x.name, x.type_oid, None if x.value is None else bytes(x.value), x.is_null) for x in columns] == [("", o, w, w is None) for o, w in zip(oids, want)]
        assert got[name].j == [None if w is None else list(w) for w in want]


codes = st.sampled_from("WIUDT")
u64 = st.integers(0, MAX)
names = st.text(st.characters(blacklist_characters="\0", blacklist_categories=["Cs"]), max_size=8)


def _parsed(chunks):
    """Records of many chunks by the vectorised search, as :func:`plain_frames` gives them."""
    import numpy as np

    ends = np.cumsum([len(c) for c in chunks])
    rows, place, error = parse.find_frames(np.frombuffer(b"".join(chunks), "u1"), ends - [len(c) for c in chunks], ends)
    assert [p for c in range(len(chunks)) for p in place[rows[:, 0] == c].tolist()] == [p for c in range(len(chunks)) for p in range(int((rows[:, 0] == c).sum()))]
    data, out = b"".join(chunks), [parse._ERRORS[e] or [] for e in error]
    for chunk, at, first, second in rows.tolist():
        out[chunk].append((at - int(ends[chunk]) + len(chunks[chunk]), data[at + 25 : first], data[first + 1 : second]))
    return out


@given(codes, u64, u64, st.integers(-(2**63), 2**63 - 1), names, names, st.integers(0, 2**24 - 1))
def test_encoded_frames_come_back(code, lsn, xid, time, schema, table, oid):
    found = plain_frames(frame_bytes(code, lsn, xid, time, schema, table, oid, b"x"))
    want = {"I": "Insert", "U": "Update", "D": "Delete", "T": "Truncate"}.get(code)
    assert found == ([(want, lsn, xid, time, schema, table, oid)] if want else [])


chunk_bytes = st.binary(max_size=120) | st.lists(st.sampled_from([b"I", b"B", b"W", b"\0", b"s\0t\0", b"\1" * 24, b"k"]), max_size=20).map(b"".join)


@given(st.lists(chunk_bytes, max_size=6), st.sampled_from([1, 2, 1000]))
@settings(max_examples=300)
def test_any_bytes_end(chunks, side_by_side):
    before, parse.SIDE_BY_SIDE = parse.SIDE_BY_SIDE, side_by_side
    try:
        found = _parsed(chunks)
    finally:
        parse.SIDE_BY_SIDE = before
    for chunk, got in zip(chunks, found):
        want = plain_frames(chunk)
        if isinstance(want, str):
            assert got == want
        else:
            assert [(s.decode("utf-8", "replace"), t.decode("utf-8", "replace")) for _, s, t in got] == [r[4:6] for r in want]


def test_random_chunks(spark):
    import random

    rng = random.Random(7)
    parts = [b"I", b"U", b"B", b"W", b"Q", b"\0", b"\0\0", b"\1" * 24, b"ab\0cd\0", b"\xff\xc3", b"xyz"]
    rows = [(i, b"".join(rng.choices(parts, k=rng.randint(0, 12)))) for i in range(400)]
    rows += [(1000 + i, frame_bytes("I", i, i, i, "s", "t", i << 20, b"x" * (i % 7))) for i in range(100)]
    rows += [(2000 + i, b"".join(frame_bytes(rng.choice("WIUDT"), MAX - i, k, -k, "\u00e9" * (k % 3), "t\U0001f600") for k in range(i % 40))) for i in range(60)]
    df = spark.createDataFrame([(i, bytearray(c)) for i, c in rows], "seq long, chunk binary").repartition(2)
    assert _found(parse_chunks(df)) == {i: want for i, c in rows if (want := plain_frames(c))}


def test_table_functions(spark):
    from tidelog.functions import udtf

    udtf.register(spark)
    chunks = [(s, i, bytearray(c)) for s in ("a", "b") for i, c in enumerate([b"", b"I" + b"\1" * 30, frame_bytes("U", 2**64 - 1, 5, -1, "s", "t"), frame_bytes("I", 1, 2, 3, "s", "t") + frame_bytes("W", 1, 2, 3, "s", "t") + frame_bytes("D", 4, 5, 6, "s", "ü", 9, b"x")])]
    df = spark.createDataFrame([*chunks, ("c", 9, None)], "slot string, seq long, chunk binary")
    want = sorted(map(str, parse_chunks(df.withColumn("seq", df.seq * 10), keep=["slot"]).drop("new_tuple", "old_tuple", "seq").select("slot", "idx", "lsn", "table_schema", "table_name", "operation", "oid", "tx_commit_time", "tx_xid", "error").collect()))
    for clause in ("", " PARTITION BY slot ORDER BY seq"):
        got = spark.sql(f"SELECT slot, idx, lsn, table_schema, table_name, operation, oid, tx_commit_time, tx_xid, error FROM parse_chunks(TABLE({{df}}){clause})", df=df)
        assert sorted(map(str, got.collect())) == want
    for bad in ("SELECT seq FROM {df}", "SELECT chunk, seq AS idx FROM {df}", "SELECT CAST(chunk AS STRING) AS chunk FROM {df}"):
        with pytest.raises(Exception, match="parse_chunks"):
            spark.sql(f"SELECT * FROM parse_chunks(TABLE({bad}))", df=df).collect()
    with pytest.raises(Exception, match="TABLE"):
        spark.sql("SELECT * FROM parse_chunks(1)").collect()
    tuples = spark.createDataFrame([(0, bytearray(b"NNtxy"), [1, 2, 3, 4]), (1, None, [7]), (2, bytearray(b"N"), []), (3, bytearray(b"t"), [5])], "k int, data binary, oids array<bigint>")
    rows = spark.sql("SELECT * FROM decode_tuples(TABLE({t}))", t=tuples).collect()
    assert sorted((r.k, r.pos, r.type_oid, r.value and bytes(r.value), r.is_null) for r in rows if r.k != 3) == [(0, 0, 1, None, True), (0, 1, 2, None, True), (0, 2, 3, b"xy", False), (0, 3, 4, None, True), (1, 0, 7, None, True)]
    assert [(bytes(r.value), r.is_null) for r in rows if r.k == 3] == [(b"", False)]


def test_values_read_from_messages(spark):
    from tidelog.functions.values import kind_of, read_message

    cases = {'"a"': "String", '""': "String", "5": "Integer", "-9223372036854775808": "Integer", "9223372036854775808": "Float", "2.0": "Float", "1e3": "Float", "true": "Boolean", "[1,2]": "Json", '{"a":null}': "Json", "[]": "Json", "null": None}
    head = '{"lsn":18446744073709551615,"table_schema":"s","table_name":"t","operation":"Insert","oid":7,"new_tuple":{"columns":[{"name":"","type_oid":1,"value":'
    tail = ',"is_null":false}]},"old_tuple":null,"tx_commit_time":-1,"tx_xid":18446744073709551614}'
    df = spark.createDataFrame([(t, head + t + tail) for t in cases], "t string, m string").select("t", read_message(F.col("m")).alias("r"))
    value = F.col("r.new_tuple.columns")[0]["value"]
    rows = df.select("t", kind_of(value).alias("kind"), F.to_json(value).alias("text"), value.isNull().alias("none"), "r.lsn", "r.tx_xid", "r.old_tuple", "r.tx_commit_time").collect()
    assert {r.t: r.kind for r in rows} == cases
    assert {r.t: r.text for r in rows if r.t in ("2.0", "5", '{"a":null}')} == {"2.0": "2.0", "5": "5", '{"a":null}': '{"a":null}'}
    assert [r.t for r in rows if r.none] == ["null"]
    assert {(int(r.lsn), int(r.tx_xid), r.old_tuple, r.tx_commit_time) for r in rows} == {(2**64 - 1, 2**64 - 2, None, -1)}
    with pytest.raises(Exception):
        spark.createDataFrame([("{broken",)], "m string").select(read_message(F.col("m")).alias("r")).select("r.lsn").collect()


def test_a_message_is_parsed_once(spark):
    """Not once for each field that is taken from it: generators and functions don't share common parts."""
    from tidelog.functions.values import read_message

    df = spark.createDataFrame([("{}",)], "m string").select(F.inline(F.array(read_message(F.col("m")))))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
