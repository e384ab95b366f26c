"""Information-theoretic sanitisation of personal data, in DataFrame expressions only.

Personal data of fixed forms (email, ip, card, phone) are the protected entities. Words that
tell which entity is meant are found from co-occurrence over the corpus: in a line, a word t
discloses an entity e if ``PMI(e; t) >= threshold * IC(e)``, where ``IC(e) = -log p(e)`` is what
there is to learn about e and ``PMI(e; t) = log(p(e | t) / p(e))`` what t tells of it. Lines that
differ in the entities only count once, so copies prove nothing. Entities are removed and
disclosing words generalised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import set_aside, written

KINDS = ("email", "ip", "card", "phone")

#: Part of its information content that a word must give away of an entity.
THRESHOLD = 0.95
#: Different lines that must show the word with the entity.
MIN_LINES = 3

# The forms' patterns; possessive repeats and the look-behinds only keep long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: What a text must hold to be searched for a form at all.
NEEDED = {
    "email": "contains({t}, '@')",
    "ip": r"{t} rlike '[0-9]\\.[0-9]'",
    "card": r"{t} rlike '[0-9][\\x20-]?[0-9]'",
    "phone": "contains({t}, '+')",
}
TERM = r"[\p{L}][\p{L}\p{N}]{2,}"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def luhn(digits: str) -> str:
    """SQL: the digits pass the Luhn test."""
    digit = f"cast(substring({digits}, -i, 1) as int)"
    doubled = f"if(i % 2 = 0, {digit} * 2 - if({digit} > 4, 9, 0), {digit})"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + {doubled}) % 10 = 0"


def valid(kind: str, value: str) -> str:
    """SQL: a match of the pattern is an entity."""
    digits = f"regexp_replace({value}, '[^0-9]', '')"
    if kind == "ip":
        return f"{value} rlike {literal(rf'^{OCTET}(?:[.]{OCTET}){{3}}$')}"
    if kind == "card":
        return f"if(length({digits}) between 16 and 19, {luhn(digits)}, false)"
    if kind == "phone":
        return f"length({digits}) between 8 and 15"
    return "true"


def found(text: str, pattern: str, test: str) -> str:
    """SQL: array of (s, e, v) of the matches that pass ``test`` of v, in code points."""
    none = "cast(array() as array<struct<s:int,e:int,v:string>>)"
    return f"""aggregate(
        regexp_extract_all({text}, {pattern}, 0),
        named_struct('i', 0, 'at', 0, 'out', {none}),
        (a, v) -> named_struct(
            'i', a.i + 1,
            'at', a.at + length(parts[a.i]) + length(v),
            'out', if({test}, concat(a.out, array(named_struct(
                's', a.at + length(parts[a.i]),
                'e', a.at + length(parts[a.i]) + length(v),
                'v', v))), a.out)),
        a -> a.out)"""


def with_spans(rows: DataFrame, kind: str, pattern: str | None = None) -> DataFrame:
    """Adds column ``kind``: the spans of the kind in ``text``; ``pattern`` may be a column."""
    own = pattern or literal(PATTERNS[kind])
    needed = NEEDED[kind].format(t="text") if pattern is None else f"{pattern} is not null"
    test = "true" if pattern else valid(kind, "v")
    parts = F.expr(f"if({needed}, split(text, {own}, -1), null)")
    spans = F.expr(
        f"if(size(parts) > 1, {found('text', own, test)}, "
        "cast(array() as array<struct<s:int,e:int,v:string>>))"
    )
    return rows.withColumn("parts", parts).withColumn(kind, spans).drop("parts")


def terms_of(line: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0)))


def replaced(spans: str, text: str) -> str:
    """SQL: ``text`` with the sorted ``spans`` (s, e, k) replaced by k, overlapping ones as one."""
    return f"""aggregate({spans}, named_struct('at', 0, 'out', ''),
        (a, x) -> named_struct(
            'at', greatest(a.at, x.e),
            'out', if(x.s < a.at, a.out, concat(a.out, substring({text}, a.at + 1, x.s - a.at), x.k))),
        a -> concat(a.out, substring({text}, a.at + 1)))"""


def lines_of(texts: DataFrame) -> DataFrame:
    """``(line, shape)``: the lines, and a hash that is blind to entities and their digits."""
    lines = texts.select(F.explode(F.split("text", "[\\r\\n]+")).alias("line"))
    shape = F.regexp_replace("line", PATTERNS["email"], "@")
    return lines.withColumn("shape", F.xxhash64(F.regexp_replace(shape, "[0-9]+", "0")))


def without_entities(lines: DataFrame) -> DataFrame:
    """``(shape, entities, terms)`` of lines: the words are those beside the entities' own spans."""
    rows = lines.withColumnRenamed("line", "text")
    for kind in KINDS:
        rows = with_spans(rows, kind)
    values = ", ".join(f"transform({k}, x -> concat('{k}:', lower(x.v)))" for k in KINDS)
    spans = ", ".join(f"transform({k}, x -> named_struct('s', x.s, 'e', x.e, 'k', ' '))" for k in KINDS)
    rows = rows.select(
        "shape",
        "text",
        F.expr(f"array_distinct(concat({values}))").alias("entities"),
        F.expr(f"array_sort(concat({spans}))").alias("spans"),
    )
    rest = F.expr(f"if(size(spans) > 0, {replaced('spans', 'text')}, text)").alias("line")
    rows = rows.select("shape", "entities", rest)
    return rows.select("shape", "entities", terms_of("line").alias("terms"))


def disclosing_terms(
    texts: DataFrame, threshold: float = THRESHOLD, min_lines: int = MIN_LINES
) -> DataFrame:
    """``(term, disclosure)``: words that reveal an entity, with the share of its information."""
    lines = lines_of(texts)
    likely = " or ".join(f"({NEEDED[k].format(t='line')})" for k in KINDS)
    # Both counts over lines take the lines apart once each; these ones are few.
    held = without_entities(lines.where(likely)).where("size(entities) > 0")
    held = written(held.distinct(), "entities")
    entity = held.select(F.explode("entities").alias("entity"), "shape").distinct()
    entity = entity.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    entity = entity.where(F.col("n_e") >= min_lines)
    pair = held.select("shape", F.explode("entities").alias("entity"), "terms")
    pair = pair.join(entity, "entity", "left_semi")
    pair = pair.select("entity", "shape", F.explode("terms").alias("term")).distinct()
    pair = pair.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"))
    pair = pair.where(F.col("n_et") >= min_lines).join(entity, "entity")
    total = lines.select("shape").distinct().count()
    share = f"1 + ln(least(1.0, n_et / n_t)) / greatest(1e-9, ln({total} / n_e))"
    # The lines with entities alone already rule out the words that are common in them.
    held = held.select("shape", F.explode("terms").alias("term")).distinct()
    held = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    pair = pair.join(held, "term").where(f"{share} >= {threshold}").drop("n_t")
    pair = written(pair, "pairs")
    if pair.isEmpty():
        return pair.select("term", F.lit(0.0).alias("disclosure"))
    seen = without_entities(lines).select("shape", F.explode("terms").alias("term"))
    seen = seen.join(pair.select("term").distinct(), "term", "left_semi").distinct()
    seen = seen.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    told = pair.join(seen, "term").withColumn("share", F.expr(share))
    told = told.where(F.col("share") >= threshold)
    return told.groupBy("term").agg(F.max("share").alias("disclosure"))


def personal_data(
    docs: DataFrame, threshold: float = THRESHOLD, min_lines: int = MIN_LINES
) -> DataFrame:
    """``docs`` with text (null as empty) and span arrays ``email, ip, card, phone, term``.

    A term span is a whole word that discloses an entity anywhere in the corpus. Spans of
    one kind never overlap; those of different kinds may. Every row stays, whatever its id.
    """
    text = docs.withColumn("text", F.coalesce("text", F.lit("")))
    terms = written(disclosing_terms(text.select("text"), threshold, min_lines), "terms")
    rows = text
    for kind in KINDS:
        rows = with_spans(rows, kind)
    if terms.isEmpty():
        none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
        return rows.withColumn("term", none)
    # By text, so that rows without an id and rows of one id get their own. Texts of one hash
    # would share their terms; a term that a text does not hold matches nothing there.
    rows = rows.withColumn("__hash", F.xxhash64("text"))
    own = text.select(F.xxhash64("text").alias("__hash"), F.explode(terms_of("text")).alias("term"))
    own = own.join(terms.select("term"), "term", "left_semi").groupBy("__hash")
    own = written(own.agg(F.sort_array(F.collect_set("term")).alias("__terms")), "doc_terms")
    rows = rows.join(own, "__hash", "left").drop("__hash")
    word = "[\\\\p{L}\\\\p{N}]"
    pattern = F.expr(
        f"concat('(?iu)(?<!{word})(?:', array_join(__terms, '|'), ')(?!{word})')"
    )
    rows = rows.withColumn("__pattern", pattern)
    return with_spans(rows, "term", "__pattern").drop("__terms", "__pattern")


def span_text(kinds: tuple[str, ...]) -> str:
    each = ", ".join(f"transform({k}, x -> concat('{k}:', x.s, ':', x.e))" for k in kinds)
    return f"array_join(concat({each}), ',')"


def report(docs: DataFrame) -> DataFrame:
    """Counts per kind, a digest of the base spans, and all spans, for each document."""
    rows = personal_data(docs.select("doc_id", "text"))
    counts = [F.expr(f"cast(size({k}) as long)").alias(f"n_{k}") for k in KINDS]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(span_text(KINDS)), 256).alias("base_sha256"),
        F.expr(span_text((*KINDS, "term"))).alias("spans"),
        F.expr("cast(size(term) as long)").alias("n_term"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The documents with entities and disclosing words replaced by the name of their kind.

    Where spans of different kinds overlap, their union is replaced by the first one's name.
    ``n_chars``, if there, is the new length. Texts without spans stay as they are, null too.
    """
    own, columns = set_aside(docs, *KINDS, "term", "parts")
    rows = personal_data(own.withColumn("__was", F.col("text")))
    kinds = (*KINDS, "term")
    tagged = ", ".join(
        f"transform({k}, x -> named_struct('s', x.s, 'e', x.e, 'k', '[{k.upper()}]'))" for k in kinds
    )
    rows = rows.withColumn("__all", F.expr(f"array_sort(concat({tagged}))"))
    new = replaced("__all", "text")
    rows = rows.withColumn("text", F.expr(f"if(size(__all) > 0, {new}, __was)"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.size("__all") > 0, length).otherwise(F.col("n_chars")))
    return rows.select(columns)
