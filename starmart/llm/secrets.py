"""Secrets in texts: spans by pattern, and weak parts of credentials that only count beside their complements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import folds, tables

# The patterns of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Weak parts: a run that could be a secret key, and the address of a service. Alone they are no finding.
KEY = r"[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"(?:https?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x00-\x20\"'<>]+"
#: Characters (code points) between parts of one credential at most: the scope in which they are linked.
SCOPE = 200


@dataclass(frozen=True)
class Kind:
    """`part` is the role in a credential: identifier, secret or endpoint. Weak kinds need complements."""

    name: str
    order: int
    part: str
    weak: bool


KINDS = (
    Kind("assign", 0, "secret", False),
    Kind("access", 1, "identifier", False),
    Kind("hex", 2, "secret", False),
    Kind("key", 3, "secret", True),
    Kind("endpoint", 4, "endpoint", True),
)


def _spans(text: Column, pattern: str, keep=lambda match: F.lit(True)) -> Column:
    """(start, end) of the leftmost matches that don't overlap, without those that `keep` refuses.

    The text is split around its matches; what lies before a match and the match itself add up to its place. Patterns
    must not match nothing.
    """

    def pieces(found: Column) -> Column:
        before = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return F.zip_with(
            before,
            found,
            lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"), keep(match).alias("kept")),
        )

    def span(at: Column, piece: Column) -> Column:
        start = at + piece["gap"]
        return F.struct(start.alias("start"), (start + piece["size"]).alias("end"), piece["kept"].alias("kept"))

    def placed(found: Column) -> Column:
        to = lambda at, piece: at + piece["gap"] + piece["size"]
        spans = folds.scan(pieces(found), F.lit(0), to, span, "struct<start:int,end:int,kept:boolean>")
        return F.transform(F.filter(spans, lambda s: s["kept"]), lambda s: F.struct(s["start"], s["end"]))

    empty = F.array().cast("array<struct<start:int,end:int>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return folds.within(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(empty))


def _mixed_case(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of id and text) and the spans of every kind, before anything is linked."""
    text = F.col("text")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    value = lambda match: F.length(F.regexp_extract(match, ASSIGN, 2)) >= LEAST_VALUE
    return keyed.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("row"),
        _spans(text, ASSIGN, value).alias("assign"),
        _spans(text, ACCESS, lambda match: F.length(match) >= LEAST_ACCESS).alias("access"),
        _spans(text, f"[0-9a-f]{{{LEAST_HEX},}}").alias("hex"),
        _spans(text, KEY, _mixed_case).alias("key"),
        _spans(text, ENDPOINT).alias("endpoint"),
    )


def _tagged(kind: Kind) -> Column:
    return F.transform(
        kind.name,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(kind.order).alias("order"), s["end"].alias("end"),
            F.lit(kind.name).alias("kind"), F.lit(kind.part).alias("part"),
        ),
    )


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, links: the weak spans that a span of another part lies next to, at most `scope` characters away.

    An interval join: every span is put into the stretches of `scope` characters that it touches, a weak one also into
    the stretches around it, and spans meet in a stretch of their text. Spans that overlap are no complements.
    """

    def spread(kinds: list[Kind], margin: int) -> DataFrame:
        spans = found.where(" + ".join(f"size({k.name})" for k in kinds) + " > 0").select(
            "row", F.explode(F.concat(*[_tagged(k) for k in kinds])).alias("s")
        )
        low = F.floor((F.col("s.start") - margin) / scope)
        high = F.floor((F.col("s.end") + margin) / scope)
        return spans.distinct().select("row", "s", F.explode(F.sequence(low, high)).alias("stretch"))

    weak = spread([k for k in KINDS if k.weak], scope).alias("w")
    others = spread(list(KINDS), 0).alias("o")
    gap = F.greatest(F.col("o.s.start") - F.col("w.s.end"), F.col("w.s.start") - F.col("o.s.end"))
    near = (
        (F.col("w.row") == F.col("o.row"))
        & (F.col("w.stretch") == F.col("o.stretch"))
        & (F.col("w.s.part") != F.col("o.s.part"))
        & (gap >= 0)
        & (gap <= scope)
    )
    return weak.join(others, near, "left_semi").groupBy("row").agg(F.collect_set("s").alias("links"))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base (spans of the base kinds), spans (these and the linked weak ones).

    Spans are kind:start:end in code points, end exclusive, by start and then by kind. Null texts are empty. Equal rows
    have equal results; rows without id are searched like others. Texts of any length are searched whole, in time that
    grows little faster than their length and their matches. Empty tables give none.
    """
    found = tables.written(parts(docs), "parts")
    base = F.concat(*[_tagged(k) for k in KINDS if not k.weak])
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,part:string>>")
    return found.join(linked(found, scope), "row", "left").select(
        "doc_id",
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in KINDS if not k.weak],
        _listed(base).alias("base"),
        _listed(F.concat(base, F.coalesce("links", none))).alias("spans"),
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
