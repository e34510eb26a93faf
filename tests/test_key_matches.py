"""J5 and J7 on keys made hard: wildcards, escapes, keys at the start, inside and at the end; no nested loop."""
import re

from parcelspark.operators import quality as Q
from survey_helpers import persons_df

MAINS = ["ab_c", "a%c", "a\\_c", "q\\z", "uuid:1", "", "_", "z\\", "plain", "plain", None, "uuid:2"]
PERSONS = ["abXc_1", "ab_c_2", "aZZc", "a_c_3", "qz9", "q\\z", "uuid:12_7", "uuid:1_9", "x_uuid:2_3", "z%1", "plain_plain", "", None, "a\\_c"]


def _like(pattern):
    """PostgreSQL LIKE: a backslash takes the next character literally."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"_": ".", "%": ".*"}.get(c, re.escape(c))
        i += 1
    return re.compile(out, re.S)


def _tables(spark):
    return spark.createDataFrame([(m,) for m in MAINS], "uuid string"), persons_df(spark, [{"uuid": p} for p in PERSONS])


def _no_nested_loop(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_like_pairs(spark):
    got = Q.match_type_join(*_tables(spark)).select("main_uuid", "person_uuid", "match_type")
    want = []
    for m in MAINS:
        for p in PERSONS:
            if m is None or p is None:
                continue
            if _like(m + "%").fullmatch(p):
                want.append((m, p, "DIRECT_MATCH"))
            elif p.split("_")[0] == m:
                want.append((m, p, "PREFIX_MATCH"))
    assert ("ab_c", "abXc_1", "DIRECT_MATCH") in want and ("q\\z", "q\\z", "PREFIX_MATCH") in want
    assert sorted(map(tuple, got.collect())) == sorted(want)
    _no_nested_loop(got)


def test_containing_pairs(spark):
    got = Q.containing_pairs(*_tables(spark))
    want = [(m, p) for m in MAINS for p in PERSONS if m is not None and p is not None and m in p]
    assert {("uuid:1", "uuid:12_7"), ("uuid:2", "x_uuid:2_3")} <= set(want)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    _no_nested_loop(got)


def test_keys_that_share_their_head_meet_by_layout(spark):
    """Pairs of one head are not tried one by one: keys with wildcards meet persons in equi-joins, LIKE only for the few."""
    mains = ["uuid:_1", "uuid:1_", "uuid:__", "uuid:%5", "uuid:1%5_", "uuid:%5%7", "uuid:1_3%", "%", "_%9", "%%_7", "uuid:1_3", "uuid:1_3", "_", "x%", "é_%é"]
    people = ["uuid:11_2", "uuid:123_55", "uuid:1", "uuid:1535_7", "uuid:59_57", "", "a9", "uuid:143", "éaéé", "x", "uuid:1\n3_5", "uuid:143"]
    tables = spark.createDataFrame([(m,) for m in mains], "uuid string"), persons_df(spark, [{"uuid": p} for p in people])
    got = Q.match_type_join(*tables).select("main_uuid", "person_uuid", "match_type")
    want = [(m, p, "DIRECT_MATCH") for m in mains for p in people if _like(m + "%").fullmatch(p)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    _no_nested_loop(got)
    # one head for all: the join is on what the keys say beyond it
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Join [_text" in text or "Join [_lay" in text


def test_containing_pairs_leave_other_substrings_out_early(spark):
    """Substrings of no key's class are dropped before the exchange on the key, and the persons are spread first."""
    got = Q.containing_pairs(*_tables(spark))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in text and "REPARTITION_BY_NUM" in text
    assert "SortMergeJoin [main_uuid" in text  # the substrings are never broadcast
    keys = spark.createDataFrame([("aa",), ("a",), ("aba",)], "uuid string")
    people = persons_df(spark, [{"uuid": u} for u in ("aaaa", "ababa", "aaaa", "b", "")])
    got = sorted(map(tuple, Q.containing_pairs(keys, people).collect()))
    assert got == sorted([("a", "aaaa"), ("aa", "aaaa")] * 2 + [("a", "ababa"), ("aba", "ababa")])


def test_texts_of_layouts_are_not_sent(spark, monkeypatch):
    """A person goes once for each head and slice; its many texts meet the keys where they lie, also when a head is dealt in parts."""
    monkeypatch.setattr(Q, "CELL_KEYS", 3)
    digits = "1234"
    mains = ["u" + "".join("_" if mask >> i & 1 else c for i, c in enumerate(digits)) for mask in range(1, 16)] * 2
    mains += ["_a_b_c_d_e_f", "_a_b_c_d_%f", "a_b_c_d_e%g_", "u%3", "u%", "u%%", "%%", "_2%"]
    people = ["u1234", "u1234_5", "u9234", "u1_34", "xaxbxcxdxexf", "xaxbxcxdxexg", "xaxbxcxdxxxf", "axbxcxdxezzgy", "axbxcxdxezzg", "u", "", "u1234"]
    tables = spark.createDataFrame([(m,) for m in mains], "uuid string"), persons_df(spark, [{"uuid": p} for p in people])
    got = Q.match_type_join(*tables).select("main_uuid", "person_uuid", "match_type")
    want = [(m, p, "DIRECT_MATCH") for m in mains for p in people if _like(m + "%").fullmatch(p)]
    assert ("_a_b_c_d_e_f", "xaxbxcxdxexf", "DIRECT_MATCH") in want and ("a_b_c_d_e%g_", "axbxcxdxezzgy", "DIRECT_MATCH") in want
    assert sorted(map(tuple, got.collect())) == sorted(want)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_text" not in text and "HashJoin [_text" in text
    _no_nested_loop(got)


def test_substrings_are_not_sent(spark):
    """A person goes once for each place of an end that stands for keys; substrings meet the keys where they lie."""
    mains = ["k:1", "k:12", "k:123", "12_x", "2_x", "123_x", "aba", "abaXaba", "aXa", "a", "ab", "", "é:é", "xyzxyz", "k:1", "yzx"]
    people = ["k:123_x9", "k:12_x", "abaXabaXaba", "aba", "a", "", "é:é:é", "xyzxyzxyz", "k:123_x9", "bXaXa"]
    tables = spark.createDataFrame([(m,) for m in mains], "uuid string"), persons_df(spark, [{"uuid": p} for p in people])
    got = Q.containing_pairs(*tables)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(main_uuid" not in text
    assert text.count("direct_shuffle_partition_id(_cell") == 2
    _no_nested_loop(got)
    assert sorted(map(tuple, got.collect())) == sorted((m, p) for m in mains for p in people if m in p)
