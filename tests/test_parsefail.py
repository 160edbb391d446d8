import csv
import datetime as dt
import io
import random
import re

import pytest
from pyspark.sql import functions as F

from sluice.operators import parsefail as pf

RULES = [(n, n) for n in ("quoting", "column_count", "subscriber_id", "hios_id", "birth_date", "amount", "modified_ts")]
GOOD = ["S0000001130", "17402H9405", "Tev", "Tor", "1974-04-21", "2206.06", "2026-05-17 04:56:48", "note"]


def scan(line, sep):
    """Fields of a record by a plain state machine, None if its quoting is broken."""
    out, i, n = [], 0, len(line)
    while True:
        j = i
        while j < n and line[j] in " \t" and line[j] != sep:
            j += 1
        if j < n and line[j] == '"':
            value, j = "", j + 1
            while True:
                if j >= n:
                    return None
                if line[j] == '"' and j + 1 < n and line[j + 1] == '"':
                    value, j = value + '"', j + 2
                elif line[j] == '"':
                    j += 1
                    break
                else:
                    value, j = value + line[j], j + 1
            while j < n and line[j] in " \t" and line[j] != sep:
                j += 1
            if j < n and line[j] != sep:
                return None
        else:
            j = i
            while j < n and line[j] != sep:
                if line[j] == '"':
                    return None
                j += 1
            value = line[i:j]
        out.append(value.strip(" \t"))
        if j >= n:
            return out
        i = j + 1


def is_time(text, fmt):
    try:
        dt.datetime.strptime(text, fmt)
        return True
    except ValueError:
        return False


def expected(line, sep):
    v = scan(line or "", sep or ",")
    if v is None:
        return "quoting"
    if len(v) != 8:
        return "column_count"
    if not re.fullmatch(r"S\d{10}", v[0], re.A):
        return "subscriber_id"
    if not re.fullmatch(r"\d{5}[A-Z]\d{4}", v[1], re.A):
        return "hios_id"
    if v[4] and not (re.fullmatch(r"\d{4}-\d\d-\d\d", v[4], re.A) and is_time(v[4], "%Y-%m-%d")):
        return "birth_date"
    if v[5] and not re.fullmatch(r"-?\d+(\.\d{1,2})?", v[5], re.A):
        return "amount"
    if not (re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", v[6], re.A) and is_time(v[6], "%Y-%m-%d %H:%M:%S")):
        return "modified_ts"
    return None


def classify(spark, lines):
    df = spark.createDataFrame([(i, line, sep, "clash") for i, (line, sep) in enumerate(lines)], "line_id bigint, raw_line string, field_delimiter string, note string")
    return pf.classify(pf.parse_lines(df, "raw_line", "field_delimiter", pf.MEMBER_READ_AS), RULES)


def write(fields, sep, quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, quoting=quoting, lineterminator="").writerow(fields)
    return out.getvalue()


def cases():
    rnd = random.Random(5)
    bad = [
        (0, ["", "S123", "s0000001130", "SO000001130", "  "]), (1, ["", "1740H9405", "17402h9405", "17402-9405", "N/A"]), (4, ["1974-4-1", "1990-02-31", "unknown", "19740421", "21/04/1974"]),
        (5, ["12O.5", "--5", "1,234.50", "45.999", "$18", "NaN", "1e3", "(4)", "ten", "+5", "5."]), (6, ["", "2026-05-27", "yesterday", "2026-02-30 01:00:00", "2026-01-01T00:00:00Z", "2026-01-01 24:00:00", "23.05.2026 13:27"]),
    ]
    for sep in (",", ";", "|", "\t", "~"):
        yield write(GOOD, sep), sep
        yield write(GOOD, sep, csv.QUOTE_ALL), sep
        yield write([*GOOD[:7], f'said "x{sep}" \n twice'], sep), sep
        yield write([f" {GOOD[0]} ", *GOOD[1:4], "", "", GOOD[6], ""], sep), sep
        yield sep.join([*GOOD[:7], ' "blank around" ']), sep
        yield sep.join([*GOOD[:7], "line\nbreak"]), sep
        yield sep.join(["", *GOOD[1:7], '"q"']), sep
        for broken in ('"open', 'a"b', '"a"b', '"x"""y"', '""x', '"a""'):
            yield sep.join([*GOOD[:7], broken]), sep
            yield sep.join([GOOD[0], broken, *GOOD[2:]]), sep
        for k in (0, 1, 2, 5, 7, 9):
            yield sep.join((GOOD + ["x"] * 3)[:k]), sep
        for at, values in bad:
            for v in values:
                fields = [*GOOD]
                fields[at] = v
                yield write(fields, sep), sep
                yield write(fields, sep, csv.QUOTE_ALL), sep
        for _ in range(60):
            yield "".join(rnd.choice([sep, '"', "a", " ", "\n", "1", '""']) for _ in range(rnd.randrange(1, 25))), sep
    yield None, ","
    yield write(GOOD, ","), None
    yield "", "|"
    yield sepless(), ","


def sepless():
    return "x" * 300_000


def test_codes_equal_a_plain_scanner(spark):
    lines = list(cases())
    got = {r.line_id: r.error_code for r in classify(spark, lines).select("line_id", "error_code").collect()}
    wrong = [(line, sep, got[i], expected(line, sep)) for i, (line, sep) in enumerate(lines) if got[i] != expected(line, sep)]
    assert not wrong, wrong[:5]


def test_valid_rows_are_typed(spark):
    rows = pf.typed_fields(classify(spark, [(write(GOOD, ","), ","), (write([*GOOD[:4], "", "", GOOD[6], 'a "b"\nc'], "|"), "|")]), ["line_id"]).orderBy("line_id").collect()
    assert rows[0].birth_date == dt.date(1974, 4, 21) and str(rows[0].amount) == "2206.06" and rows[0].modified_ts == dt.datetime(2026, 5, 17, 4, 56, 48)
    assert rows[1].birth_date is None and rows[1].amount is None and rows[1].note == 'a "b"\nc'


def test_quoting_of_very_long_fields(spark):
    long = '"' + '""x' * 200_000 + '"'
    assert classify(spark, [(",".join([*GOOD[:7], long]), ","), (",".join([*GOOD[:7], long[:-1]]), ",")]).orderBy("line_id").select("error_code").collect() == [(None,), ("quoting",)]


def test_rule_order_comes_from_the_table(spark):
    rules = spark.createDataFrame([("quoting", 2, "Q"), ("column_count", 1, "C")], "rule_name string, rule_order int, error_code string")
    assert pf.ordered_rules(rules) == [("column_count", "C"), ("quoting", "Q")]
    with pytest.raises(ValueError, match="no check is known"):
        pf.classify(pf.parse_lines(spark.createDataFrame([("a", ",")], "raw_line string, field_delimiter string"), "raw_line", "field_delimiter", pf.MEMBER_READ_AS), [("other", "X")])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "raw_line string, field_delimiter string")
    assert pf.classify(pf.parse_lines(empty, "raw_line", "field_delimiter", pf.MEMBER_READ_AS), RULES).filter(F.col("error_code").isNotNull()).count() == 0
