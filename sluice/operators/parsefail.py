"""Delimited records: valid rows apart from those that break a rule, with the reason.

The records are read permissively under an explicit schema, keeping the raw text of
those Spark calls corrupt. Records read whole only need the checks no cast makes.
Corrupt ones, and those with quotes (which the reader forgives where they are stray),
are classified again from the raw text: quoting, number of fields, one check per
column. The delimiter may differ from row to row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for the row's own delimiter while a record is parsed; a noncharacter no text may hold.
MARK = "\ufdd0"
_QUOTED = r'[ \t]*+"(?:[^"]++|"")*+"[ \t]*+'
_FIELD = rf'(?:{_QUOTED}|[^"{MARK}]*+)'
WELL_QUOTED = rf"\A{_FIELD}(?:{MARK}{_FIELD})*+\z"
#: To be searched in a line with one more mark in front: else an empty first field hides the second.
EACH_FIELD = rf"{MARK}({_FIELD})"


@dataclass(frozen=True)
class FieldRule:
    """A pattern a trimmed value must match wholly, and whether it may be empty."""

    pattern: str
    required: bool
    calendar: str | None = None


#: What the rules of TESTDATA.md's reject_rule state, by rule name.
MEMBER_FIELDS = ("subscriber_id", "hios_id", "first_name", "last_name", "birth_date", "amount", "modified_ts", "note")
MEMBER_RULES = {
    "subscriber_id": FieldRule(r"S[0-9]{10}", True),
    "hios_id": FieldRule(r"[0-9]{5}[A-Z][0-9]{4}", True),
    "birth_date": FieldRule(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", False, "yyyy-MM-dd"),
    "amount": FieldRule(r"-?[0-9]+(?:\.[0-9]{1,2})?", False),
    "modified_ts": FieldRule(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}", True, "yyyy-MM-dd HH:mm:ss"),
}
MEMBER_TYPES = "subscriber_id string, hios_id string, first_name string, last_name string, birth_date date, amount decimal(18,2), modified_ts timestamp_ntz, note string"
#: As read: the amount stays text, since Spark's cast rounds and takes forms the rule refuses.
MEMBER_READ_AS = MEMBER_TYPES.replace("decimal(18,2)", "string")


def _trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ \t]+|[ \t]+$", "")


def _once(df: DataFrame, name: str, c: Column) -> DataFrame:
    """Adds a column behind a generator, so that filters on it don't repeat its expression below."""
    return df.withColumn(name, F.explode(F.array(c)))


def parse_lines(df: DataFrame, line: str, delimiter: str, types: str) -> DataFrame:
    """Adds the permissive reading, the strict fields and the structural flags.

    ``__read`` is Spark's reading, its ``_raw`` the text it calls corrupt; ``__whole`` says
    that it needs no second look. For the others ``__fields`` has the values without quotes
    and outer blanks, null if the quoting is broken. A null line counts as an empty
    record, a null delimiter as a comma.
    """
    raw = F.coalesce(F.col(line), F.lit(""))
    sep = F.coalesce(F.col(delimiter), F.lit(","))
    marked = F.replace(F.replace(raw, F.lit(MARK), F.lit("\ufffd")), sep, F.lit(MARK))
    options = {
        "sep": MARK,
        "mode": "PERMISSIVE",
        "quote": '"',
        "escape": '"',
        "multiLine": "true",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "dateFormat": "yyyy-MM-dd",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
        "columnNameOfCorruptRecord": "_raw",
    }
    df = df.withColumn("__line", marked)
    df = _once(df, "__read", F.from_csv(F.col("__line"), f"{types}, _raw string", options))
    df = df.withColumn("__quoted", F.col("__line").contains('"'))
    df = df.withColumn("__whole", F.coalesce(F.col("__line").contains(MARK) & F.col("__read._raw").isNull() & ~F.col("__quoted"), F.lit(False)))
    df = df.withColumn("__well_quoted", ~F.col("__quoted") | F.col("__line").rlike(WELL_QUOTED))
    plain = F.split(F.col("__line"), MARK, -1)
    strict = F.regexp_extract_all(F.concat(F.lit(MARK), F.col("__line")), F.lit(EACH_FIELD), F.lit(1))
    pieces = F.when(F.col("__whole"), F.lit(None)).when(~F.col("__quoted"), plain).when(F.col("__well_quoted"), strict)

    def bare(c: Column) -> Column:
        t = _trimmed(c)
        stripped = F.replace(F.regexp_replace(t, r'\A"|"\z', ""), F.lit('""'), F.lit('"'))
        return F.replace(_trimmed(F.when(t.startswith('"'), stripped).otherwise(t)), F.lit(MARK), sep)

    return _once(df, "__fields", F.transform(pieces, bare))


def _breaks(rule: str, fields: tuple[str, ...], rules: dict[str, FieldRule], types: dict[str, str]) -> Column:
    if rule == "quoting":
        return ~F.col("__well_quoted")
    if rule == "column_count":
        return ~F.col("__whole") & F.coalesce(F.size("__fields") != len(fields), F.lit(False))
    if rule not in rules:
        raise ValueError(f"no check is known for the rule {rule!r}; known: quoting, column_count, {', '.join(rules)}")
    r, v = rules[rule], F.coalesce(F.get(F.col("__fields"), F.lit(fields.index(rule))), F.lit(""))
    ok = v.rlike(rf"\A{r.pattern}\z")
    if r.calendar:
        read = F.try_to_timestamp(v, F.lit(r.calendar)) if "H" in r.calendar else F.try_to_date(v, r.calendar)
        ok = ok & F.coalesce(F.when(ok, read.isNotNull()), F.lit(False))
    again = ~ok if r.required else (v != "") & ~ok
    seen = F.col(f"__read.{rule}")
    if r.calendar and types[rule] != "string":
        first = seen.isNull() if r.required else F.lit(False)  # what was read whole was read by the rule's format
    else:
        first = ~F.coalesce(seen, F.lit("")).rlike(rf"\A{r.pattern}\z")
        first = first if r.required else first & (F.coalesce(seen, F.lit("")) != "")
    return F.when(F.col("__whole"), first).otherwise(again)


def _types(text: str) -> dict[str, str]:
    return dict(t.strip().split(" ", 1) for t in re.split(r",(?![^()]*\))", text))


def classify(parsed: DataFrame, rules: list[tuple[str, str]], fields: tuple[str, ...] = MEMBER_FIELDS, checks: dict[str, FieldRule] | None = None, types: str = MEMBER_READ_AS) -> DataFrame:
    """Adds ``error_code`` of the first broken rule in the given order, null for valid rows.

    ``rules`` are (rule name, error code) pairs in rule order. A record whose quoting
    is broken has no fields, so it also breaks every rule on a required value.
    """
    code = F.lit(None).cast("string")
    for name, error in reversed(rules):
        code = F.when(F.coalesce(_breaks(name, fields, checks or MEMBER_RULES, _types(types)), F.lit(False)), F.lit(error)).otherwise(code)
    return _once(parsed, "error_code", code)


def ordered_rules(rules: DataFrame, cap: int = 1_000) -> list[tuple[str, str]]:
    """The rule table as configuration; refuses a table beyond ``cap`` rows."""
    got = rules.select("rule_name", "rule_order", "error_code").orderBy("rule_order", "rule_name").limit(cap + 1).collect()
    if len(got) > cap:
        raise ValueError(f"more than {cap} reject rules")
    return [(r.rule_name, r.error_code) for r in got if r.rule_name is not None]


def typed_fields(classified: DataFrame, keep: list[str], fields: tuple[str, ...] = MEMBER_FIELDS, types: str = MEMBER_TYPES) -> DataFrame:
    """Valid rows with typed columns: as read, or the strict fields cast where the record was classified again. Empty values are null."""
    out = []
    for i, name in enumerate(fields):
        text = F.get(F.col("__fields"), F.lit(i))
        text = F.when(text != "", text)
        kind = _types(types)[name]
        again = text if kind == "string" else text.try_cast(kind)
        out.append(F.when(F.col("__whole"), F.col(f"__read.{name}").try_cast(kind)).otherwise(again).alias(name))
    return classified.filter(F.col("error_code").isNull()).select(*keep, *out)
