"""Declarative caption search: a dataset's specification and options become one lazy DataFrame."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.patterns import any_whole_word, holds


def is_unset(value) -> bool:
    """A blank or ``*`` option takes no part in a query."""
    return value is None or (isinstance(value, str) and value.strip() in ("", "*"))


@dataclass(frozen=True)
class DatasetSpec:
    """What a captioned dataset offers: where it lies, its text columns, what it can be filtered by and in which order it is read."""

    name: str
    files: str
    text_columns: tuple[str, ...]
    url_column: str | None = None
    splits: dict[str, str] = field(default_factory=dict)
    first_file: str | None = None
    thresholds: dict[str, tuple[str, str]] = field(default_factory=dict)
    ranges: dict[str, str] = field(default_factory=dict)
    extras: dict[str, str] = field(default_factory=dict)
    order: tuple[str, ...] = ()
    caption: Callable[[Column, dict], Column] | None = None

    def path(self, base: str, split: str | None = None, quick: bool = False) -> str:
        """The files to read: one split's, only the first for a quick trial, or all."""
        if quick and self.first_file:
            return f"{base}/{self.first_file}"
        if not is_unset(split):
            if split not in self.splits:
                raise ValueError(f"{self.name} has no split {split!r}")
            return f"{base}/{self.splits[split]}"
        return f"{base}/{self.files}"

    def bind(self, df: DataFrame) -> DataFrame:
        """The frame itself, once every column that the specification names is found in it."""
        named = {*self.text_columns, *(c for c, _ in self.thresholds.values()), *self.ranges.values(), *self.extras.values(), *self.order} - {None}
        if missing := sorted(named - set(df.columns)):
            raise ValueError(f"{self.name} lacks columns {missing}")
        return df


def split_terms(value: str) -> list[list[str]]:
    """Space-separated terms, all required; ``|`` inside one separates alternatives, ``+`` stands for a space."""
    return [[a.replace("+", " ").lower() for a in term.split("|") if a] for term in value.split() if term.strip("|")]


def search_terms(column: Column, value: str) -> Column:
    """Substring search without regard to case; a null text matches nothing."""
    one = lambda a: holds(F.contains(F.lower(column), F.lit(a)))
    return reduce(Column.__and__, [reduce(Column.__or__, map(one, alts)) for alts in split_terms(value)], F.lit(True))


def exclude_words(column: Column, value: str) -> Column:
    """Drops a text that has any of the words as a whole word; a null text stays."""
    words = [a for alts in split_terms(value) for a in alts]
    return ~holds(F.rlike(column, F.lit(any_whole_word(words)))) if words else F.lit(True)


def parse_range(value: str) -> tuple[int, int]:
    """``"3"`` or ``"1-4"``, both ends included; a range that runs backwards is an error."""
    m = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", value)
    if not m:
        raise ValueError(f"not a number or range: {value!r}")
    lo, hi = int(m[1]), int(m[2] or m[1])
    if hi < lo:
        raise ValueError(f"backwards range: {value!r}")
    return lo, hi


def in_range(column: Column, value: str) -> Column:
    lo, hi = parse_range(value)
    return column == lo if lo == hi else column.between(lo, hi)


def predicate(spec: DatasetSpec, options: dict) -> Column:
    """The conjunction of all options that are set; cheap numeric tests come before text ones. A null number fails its threshold."""
    conds = []
    for name, (column, op) in spec.thresholds.items():
        if not is_unset(v := options.get(name)):
            conds.append(F.col(column) >= v if op == ">=" else F.col(column) <= v)
    for name, column in spec.ranges.items():
        if not is_unset(v := options.get(name)):
            conds.append(in_range(F.col(column), str(v)))
    text = F.col(options.get("column") or spec.text_columns[0])
    if not is_unset(v := options.get("search")):
        conds.append(search_terms(text, v))
    if not is_unset(v := options.get("exclude")):
        conds.append(exclude_words(text, v))
    return reduce(Column.__and__, conds, F.lit(True))


def run_search(df: DataFrame, spec: DatasetSpec, options: dict) -> DataFrame:
    """Filter, project (url, caption, extras), stable order with nulls last, offset and limit. Validated before anything runs."""
    limit, start = options.get("limit"), options.get("start", 0)
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    if start < 0:
        raise ValueError("start must not be negative")
    kept = spec.bind(df).where(predicate(spec, options))
    text = F.col(options.get("column") or spec.text_columns[0])
    caption = spec.caption(text, options) if spec.caption else fold_newlines(text, options.get("newlines", "space"))
    columns = [clean_url(F.col(spec.url_column)).alias("url")] if spec.url_column else []
    columns += [caption.alias("text"), *[F.col(c).alias(n) for n, c in spec.extras.items()]]
    if spec.order:
        kept = kept.orderBy(*[F.col(c).asc_nulls_last() for c in spec.order])
    if start:
        kept = kept.offset(start)
    if limit is not None:
        kept = kept.limit(limit)
    return kept.select(*columns)


def fold_newlines(text: Column, mode: str = "space") -> Column:
    """Line breaks as one space, as a literal ``\\n``, or kept."""
    if mode == "space":
        return F.trim(F.regexp_replace(text, r"[\t\n\f\r ]*[\r\n]+[\t\n\f\r ]*", " "))
    if mode == "escape":
        return F.replace(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\\n")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\n"))
    if mode == "keep":
        return text
    raise ValueError(f"unknown newline mode {mode!r}")


def clean_url(url: Column) -> Column:
    return F.trim(F.regexp_replace(url, "[\r\n]+", ""))


def drop_prefix(text: Column, phrases: list[str]) -> Column:
    """Removes stock openings from the front of a text, repeated ones too, whatever their case."""
    any_of = "|".join(re.escape(p) for p in phrases)
    return F.regexp_replace(text, rf"(?iu)^(?:(?:{any_of})[\t\n\f\r ]*)+", "")


def slug(value: str, most: int = 80) -> str:
    """A file name for a query."""
    s = re.sub(r"[^\w-]+", "-", re.sub(r"[|+]", "-", value.lower())).strip("-")
    return re.sub(r"-{2,}", "-", s)[:most].strip("-")


def active_options(options: dict, defaults: dict) -> dict:
    return {k: v for k, v in options.items() if not is_unset(v) and v != defaults.get(k)}


#: Rows of a CSV file at most: a file with line breaks in its values is read by one task.
FILE_ROWS = 50_000


def write_result(df: DataFrame, path: str, options: dict, defaults: dict, single: bool = False) -> int:
    """Writes CSV with a header in each of its files and, beside it, the options in force with the row count, counted while writing.
    ``single`` asks for one file, which one task writes and reads."""
    from pyspark.sql import Observation

    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("escape", '"')
    (writer if single else writer.option("maxRecordsPerFile", FILE_ROWS)).csv(path)
    rows = seen.get["rows"]
    note = json.dumps({"options": active_options(options, defaults), "rows": rows}, ensure_ascii=False, sort_keys=True)
    df.sparkSession.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.query")
    return rows


def read_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of files or datasets by column name; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in paths])


def parse_boolean(words: list[str]) -> list[list[str]]:
    """``a AND b c`` is (a and b) or c: words side by side or joined by OR are alternatives. AND and OR count in capitals only."""
    groups: list[list[str]] = []
    joining = expecting = False
    for w in words:
        if w in ("AND", "OR"):
            if not groups or expecting:
                raise ValueError(f"{w} needs a word before it")
            joining, expecting = w == "AND", True
        else:
            if joining:
                groups[-1].append(w)
            else:
                groups.append([w])
            joining = expecting = False
    if expecting or not groups:
        raise ValueError("the query ends with an operator" if groups else "the query is empty")
    return groups


def match_boolean(column: Column, groups: list[list[str]], pattern: Callable[[str], str]) -> Column:
    one = lambda term: holds(F.rlike(column, F.lit(pattern(term))))
    return reduce(Column.__or__, [reduce(Column.__and__, map(one, g)) for g in groups])


def term_frequencies(df: DataFrame, column: str, terms: list[str], pattern: Callable[[str], str]) -> DataFrame:
    """Number of rows that each term matches, all in one pass."""
    sums = [F.coalesce(F.sum(F.when(holds(F.rlike(F.col(column), F.lit(pattern(t)))), 1)), F.lit(0)).alias(f"t{i}") for i, t in enumerate(terms)]
    one = df.agg(*sums)
    pairs = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"t{i}").cast("long").alias("n_rows")) for i, t in enumerate(terms)])
    return one.select(F.explode(pairs).alias("p")).select("p.*")
