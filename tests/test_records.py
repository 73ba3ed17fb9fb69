from pairforge.sources import records


def test_lenient_and_strict_decoding(spark):
    lines = [
        "1<CODESPLIT>0xa<CODESPLIT>0xa<CODESPLIT>f<CODESPLIT>g",
        "0<CODESPLIT>0xa<CODESPLIT>0xb<CODESPLIT>f",
        "",
        "x<CODESPLIT>0xa<CODESPLIT>0xb<CODESPLIT>f<CODESPLIT>g",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    lenient = records.decode_lenient(df).collect()
    assert sorted(r.label for r in lenient) == ["1", "x"]
    strict = records.decode_strict(df).collect()
    ok = [r for r in strict if r.error is None]
    assert len(ok) == 1 and ok[0].label == 1
    assert sorted(r.error for r in strict if r.error) == ["label_not_int", "too_few_fields", "too_few_fields"]


def test_writer_quarantines_delimiter_and_removes_line_breaks(spark):
    df = spark.createDataFrame([(1, "a", "b", "f\nx", "g y"), (0, "a", "b", "bad<CODESPLIT>", "g")],
                               "label int, codehash1 string, codehash2 string, func1 string, func2 string")
    enc = records.encode_records(df).collect()
    good = [r for r in enc if r.error is None]
    assert len(good) == 1 and good[0].value == "1<CODESPLIT>a<CODESPLIT>b<CODESPLIT>fx<CODESPLIT>gy"
    assert [r.error for r in enc if r.error] == ["delimiter_in_field"]


def test_review_lines(spark):
    df = spark.createDataFrame([("0xa", "0xb", "f a", "g\nb")], "codehash_a string, codehash_b string, func_a string, func_b string")
    r = records.encode_review(df).collect()[0]
    assert r.value == "0xa<SPLIT>0xb<SPLIT>f a<SPLIT>gb" and r.error is None


def test_strict_reader_modes(spark):
    import pytest
    df = spark.createDataFrame([("1<CODESPLIT>a<CODESPLIT>b<CODESPLIT>f<CODESPLIT>g",), ("oops",)], "value string")
    assert records.decode_strict(df, mode="dropmalformed").count() == 1
    with pytest.raises(Exception, match="malformed pair record"):
        records.decode_strict(df, mode="failfast").collect()
    with pytest.raises(ValueError):
        records.decode_strict(df, mode="bogus")


def test_records_are_cleaned_and_stripped_once(spark):
    fields = [("a |", "b", None), ("a|\n|", "b", "c"), ("a", "b", "c"), ("x|", "|y", "")]
    df = spark.createDataFrame(fields, "codehash1 string, func1 string, func2 string")
    # a delimiter that may overlap itself, and one that may not
    for delim in ("||", "|"):
        got = records.encode_records(df, ("codehash1", "func1", "func2"), delim).collect()
        clean = [["".join((f or "").splitlines()) for f in row] for row in fields]
        assert [r.value for r in got] == [delim.join(c) for c in clean]
        assert [k for k, r in enumerate(got) if r.error] == [
            k for k, c in enumerate(clean) if any(delim in f for f in c) or len(delim.join(c).split(delim)) != 3], delim
    rows = ["\x1f　 1<CODESPLIT>a<CODESPLIT><CODESPLIT>f<CODESPLIT>g  \x85", "<CODESPLIT>" * 4, "<CODESPLIT>" * 5]
    got = records.decode_lenient(spark.createDataFrame([(x,) for x in rows], "value string"))
    assert [tuple(r) for r in got.collect()] == [("1", "a", "", "f", "g"), ("",) * 5]
    once = records.encode_records(df, ("codehash1", "func1", "func2"))._jdf.queryExecution().analyzed().toString()
    assert once.count("regexp_replace") == 2  # the line, and the line in its check
