"""Personal data by patterns, and by contexts that the patterns' finds induce; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.common import neutral, picked, spread_join, stored

KINDS = ("email", "ip", "card", "phone")
#: The kind of identifiers that contexts discover.
DISCOVERED = "id"
# The same matches as the plain patterns, leftmost and non-overlapping. A run of one class is entered at its start or where
# the last match ended, and never given back, so long runs take linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A word with a digit or an @ in it: a candidate for an identifier.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
#: Rounds of scoring; a pattern's confidence is that of its instances, an instance's that of its best pattern.
ROUNDS = 3
#: Expected share of identifiers behind a pattern, and the number of known ones, from which on it may discover.
CONFIDENCE = 0.8
SUPPORT = 5
#: Characters of the context before a candidate.
CONTEXT = 48
_SPANS = "array<struct<begin:int,end:int,word:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Begin, end and word of every match, in code points: lengths of the gaps between matches and of the matches, added up."""
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, word: F.struct(F.length(gap).alias("gap"), word.alias("word")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["word"])
        span = F.struct(begin.alias("begin"), end.alias("end"), x["word"].alias("word"))
        return F.when(x["word"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found")))

    return F.aggregate(pairs, start, step, lambda acc: acc["found"])


def _small(part: Column) -> Column:
    digits = F.regexp_replace(part, "^0+", "")
    return (F.length(digits) <= 3) & (F.coalesce(digits.try_cast("int"), F.lit(0)) <= 255)


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda word: F.lit(True),
    "ip": lambda word: F.forall(F.split(word, r"\."), _small),
    "card": lambda word: F.length(_digits(word)).between(16, 19) & F.call_function("luhn_check", _digits(word)),
    "phone": lambda word: F.length(_digits(word)).between(8, 15),
}
#: What a text must hold for a kind's pattern to be tried.
HINTS: dict[str, Callable[[Column], Column]] = {
    "email": lambda text: F.instr(text, "@") > 0,
    "ip": lambda text: text.rlike("[0-9]"),
    "card": lambda text: text.rlike("[0-9]"),
    "phone": lambda text: F.instr(text, "+") > 0,
}


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind by its pattern and check."""
    return {kind: _checked(kind, F.when(HINTS[kind](text), matches(text, PATTERNS[kind])).otherwise(F.array().cast(_SPANS))) for kind in KINDS}


def _checked(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda x: CHECKS[kind](x["word"]))


def _labelled(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"), F.lit(kind).alias("kind")))


def _bare(word: Column) -> Column:
    """A candidate without punctuation at its end."""
    return F.regexp_replace(word, r"[.,;:!?)\]}\"']+$", "")


def _before(text: Column, begin: Column) -> Column:
    """The last characters before a place, lower-cased."""
    return F.lower(F.substring(text, F.greatest(begin - (CONTEXT - 1), F.lit(1)), F.least(begin, F.lit(CONTEXT))))


def _candidates(text: Column) -> Column:
    """Words with a digit or an @, each with the last characters before it."""
    pairs = F.when(text.rlike("[0-9@]"), matches(text, CANDIDATE)).otherwise(F.array().cast(_SPANS))
    return F.transform(pairs, lambda x: F.struct(x["begin"].alias("begin"), (x["begin"] + F.length(_bare(x["word"]))).alias("end"), _bare(x["word"]).alias("word"), _before(text, x["begin"]).alias("before")))


def _located(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Base spans and candidates of every row, each row with a number of its own; written once, so that numbers stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(*keep, F.monotonically_increasing_id().alias("_row"), *(x.alias(f"_{k}") for k, x in base_spans(text).items()), _candidates(text).alias("_candidates"))
    return stored(found, "pii", "zstd")


def _contexts() -> tuple[Column, Column]:
    """The patterns of the word and of the two words before a candidate."""
    context = F.regexp_extract(F.col("before"), r"(\S+)\s+(\S+)\s+$", 0)
    last = F.regexp_extract(F.col("before"), r"(\S+)\s+$", 1)
    return F.concat(F.lit("1 "), last), F.concat(F.lit("2 "), F.trim(F.regexp_replace(context, r"\s+", " ")))


def _discovered(located: DataFrame) -> DataFrame:
    """Row, begin and end of candidates that high-confidence patterns point at and no base span covers.

    Patterns are the word before, the two words before, and how the candidate itself opens (up to = or :, else its
    first four letters). Edges join patterns and instances (distinct candidate words); seeds are instances that a base
    span covers, with or without digits. Confidence alone decides: each round takes the mean confidence of a pattern's
    instances over n + 1, then the best pattern of each instance. Sums combine before the shuffle, and a frequent word or
    pattern meets its score under a salt.
    """
    seed = F.exists("base", lambda b: (b["begin"] < F.col("c.end")) & (b["end"] > F.col("c.begin")))
    opening = F.coalesce(F.nullif(F.regexp_extract("word", r"^([^\s=:]{2,32}[=:])", 1), F.lit("")), F.regexp_extract("word", r"^([A-Za-z]{4})", 1))
    patterns = F.array(*_contexts(), F.concat(F.lit("o "), opening))
    base = F.concat(*(F.col(f"_{k}") for k in KINDS))
    each = located.select("_row", base.alias("base"), F.explode("_candidates").alias("c")).select("_row", "c.*", seed.alias("seed"))
    edges = each.select("word", "seed", F.explode(F.filter(patterns, lambda p: F.length(p) > 2)).alias("pattern"))
    edges = stored(edges.groupBy("pattern", "word").agg(F.max("seed").alias("seed")), "pii-edges")
    score = edges.groupBy("word").agg(F.max(F.col("seed").cast("double")).alias("score"), F.max("seed").alias("known"))
    for _ in range(ROUNDS):
        joined = spread_join(edges.select("pattern", "word"), score.select("word", "score"), ["word"], F.col("pattern"))
        confidence = joined.groupBy("pattern").agg((F.sum("score") / (F.count("*") + 1)).alias("confidence"), F.sum(F.when(F.col("score") >= CONFIDENCE, 1).otherwise(0)).alias("support"))
        sure = stored(confidence.where((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)).select("pattern", "confidence"), "pii-sure")
        best = spread_join(edges, sure, ["pattern"], F.col("word"), "left").groupBy("word").agg(F.max("seed").alias("known"), F.coalesce(F.max("confidence"), F.lit(0.0)).alias("confidence"))
        score = stored(best.select("word", F.when(F.col("known"), 1.0).otherwise(F.col("confidence")).alias("score"), "known"), "pii-score")
    found = score.where(~F.col("known") & (F.col("score") >= CONFIDENCE)).select("word")
    return spread_join(each.where(~F.col("seed")), found, ["word"], F.col("_row")).select("_row", "begin", "end")


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["begin"].cast("string"), x["end"].cast("string")))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row.

    Base spans are those of PATTERNS that pass CHECKS; contexts of these add spans of kind `id`, which overlap no
    base span. Offsets are code points, end exclusive. Null and empty texts have no spans; repeated ids and rows
    are answered one by one; other columns are ignored; an empty table gives no rows.
    """
    docs = picked(docs, id_col, text_col).toDF("c0", "c1")
    located = _located(docs, "c1", ["c0"])
    added = _discovered(located).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("_added"))
    found = located.drop("_candidates").join(added, "_row", "left")
    base = F.concat(*(_listed(k, F.col(f"_{k}")) for k in KINDS))
    extra = F.coalesce(_listed(DISCOVERED, F.col("_added")), F.array().cast("array<string>"))
    return found.select(
        F.col("c0").alias(id_col),
        *(F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", F.concat(base, extra)).alias("spans"),
    )


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """docs with every span, base or added, replaced by its kind in brackets; overlapping spans are replaced as one.

    Only rows with candidates are joined to those that are accepted; all others keep their place. length_col, if given, is set to the new length in code points. Null texts stay null, empty ones empty; repeated ids
    and rows are treated one by one; names of other columns may clash; an empty table gives no rows.
    """
    names = docs.columns
    text_at, length_at = names.index(text_col), names.index(length_col) if length_col else None
    docs = neutral(docs)
    columns, text_col = docs.columns, f"c{text_at}"
    located = _located(docs, text_col, columns)
    found = _discovered(located).groupBy("_row").agg(F.collect_list(F.struct(F.col("begin"), F.col("end"), F.lit(DISCOVERED).alias("kind"))).alias("_added"))
    base = F.concat(*(_labelled(k, F.col(f"_{k}")) for k in KINDS))
    nothing = F.array().cast("array<struct<begin:int,end:int,kind:string>>")
    rows = located.withColumn("_base", base).select(*columns, "_row", "_base", (F.size("_candidates") > 0).alias("_open"))
    plain = rows.where(~F.col("_open")).withColumn("_added", nothing)
    joined = rows.where("_open").join(found, "_row", "left").withColumn("_added", F.coalesce("_added", nothing)).select(*plain.columns)
    out = plain.unionByName(joined).withColumn("_spans", _disjoint(F.array_sort(F.concat("_base", "_added"))))
    text = F.when(F.size("_spans") == 0, F.col(text_col)).otherwise(_replaced(F.col(text_col), F.col("_spans")))
    out = out.withColumn(text_col, F.when(F.col(text_col).isNotNull(), text))
    if length_col:
        name = f"c{length_at}"
        out = out.withColumn(name, F.length(text_col).cast(docs.schema[name].dataType))
    return out.select(*columns).toDF(*names)


def _disjoint(spans: Column) -> Column:
    """Sorted spans with overlapping ones merged; the first one's kind stays."""
    empty = F.array().cast("array<struct<begin:int,end:int,kind:string>>")

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        wider = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], x["end"]).alias("end"), last["kind"].alias("kind"))
        meets = (F.size(acc) > 0) & (last["end"] > x["begin"])
        return F.when(meets, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(spans, empty, step)


def _replaced(text: Column, spans: Column) -> Column:
    begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda x: x["end"]))
    pieces = F.transform(spans, lambda x, i: F.concat(F.substring(text, begins[i] + 1, x["begin"] - begins[i]), F.lit("["), x["kind"], F.lit("]")))
    return F.concat(F.array_join(pieces, ""), F.substring(text, F.element_at(begins, -1) + 1, F.length(text)))
