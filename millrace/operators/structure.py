"""Sections, outlines, abstracts, titles, algorithms and mentions, as arrays inside the row or as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType

from ..functions import text as T

# Section names and the headers that open them.
NAMES = {
    "Abstract": ("abstract",), "Introduction": ("introduction",), "Background": ("background",), "Related Work": ("related work", "related works", "related literature", "literature review"), "Methodology": ("methodology",),
    "Methods": ("methods", "method"), "Approach": ("approach",), "Implementation": ("implementation",), "Results": ("results", "result"), "Discussion": ("discussion",), "Conclusion": ("conclusion", "conclusions"),
    "References": ("references", "bibliography", "reference", "works cited"), "Appendix": ("appendix", "appendices", "supplementary", "supplement"), "Preliminaries": ("preliminaries",), "Experiments": ("experimental setup", "experiments"),
    "Evaluation": ("evaluation",), "Analysis": ("analysis",), "Future Work": ("future work",), "Limitations": ("limitations",), "Acknowledgments": ("acknowledgments", "acknowledgements"),
}
# Kinds of numbered and unnumbered headings, in the order they are tried; level of each.
HEADINGS = (
    ("sub", r"^([0-9]+(?:\.[0-9]+)+)\.?[ \t]+([A-Z][^\n]{1,99})$"), ("arabic", r"^([0-9]{1,2})\.?[ \t]+([A-Z][^\n]{1,99})$"), ("roman", r"^([IVX]{1,5})\.[ \t]+([A-Z][^\n]{1,99})$"),
    ("letter", r"^([A-Z])\.[ \t]+([A-Z][^\n]{1,99})$"), ("paren", r"^\(([0-9a-z])\)[ \t]+([A-Z][^\n]{1,99})$"), ("caps", r"^()([A-Z][A-Z ]{3,60})$"),
    ("keyword", r"^()((?:Abstract|Introduction|Related Work|Background|Methods?|Methodology|Experiments?|Results|Discussion|Conclusions?|References|Bibliography|Acknowledge?ments?|Appendix)):?$"),
)


def heading_name(line: Column) -> Column:
    """The section that a line opens, or null."""
    bare = T.strip(F.regexp_replace(F.lower(line), r"^(?:section[ \t]+)?(?:[0-9]+(?:\.[0-9]+)*|[ivx]+)[.):]?[ \t]+|[:.]$", ""))
    fits = (F.length(line) >= 3) & (F.length(line) < 100) & ~line.contains("@") & ~line.rlike("^[0-9]+$")

    def name_of(b: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, starts in reversed(NAMES.items()):
            hit = F.lit(False)
            for s in starts:
                hit = hit | (b == s) | ((F.length(b) < 40) & F.startswith(b, F.lit(s + " ")) & line.rlike("^[0-9A-Z]"))
            out = F.when(hit, name).otherwise(out)
        return out

    return F.when(fits, F.when(line.rlike(r"^\[1\]"), "References").otherwise(T.let(bare, name_of)))


def lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, line (from 0), value, start (character offset)."""
    arr = F.split("text", "\n")
    out = docs.select(key, F.posexplode(arr).alias("line", "value"))
    w = Window.partitionBy(key).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn("start", F.coalesce(F.sum(F.length("value") + 1).over(w), F.lit(0)).cast("long"))


def sections(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, section, start_char, end_char, text: the stretches between headers, the first one Introduction; empty ones go. A line
    that begins with ``[1]`` opens the references, but within them it is an entry."""
    rows = lines(docs, key).withColumn("name", heading_name(F.col("value")))
    w = Window.partitionBy(key).orderBy("line")
    before = F.coalesce(F.last("name", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(""))
    entry = (F.col("name") == "References") & F.col("value").rlike(r"^\[1\]") & (before == "References")
    rows = rows.withColumn("name", F.when(~F.coalesce(entry, F.lit(False)), F.col("name"))).withColumn("header", F.col("name").isNotNull())
    rows = rows.withColumn("island", F.sum(F.col("name").isNotNull().cast("int")).over(w)).withColumn("name", F.coalesce(F.last("name", ignorenulls=True).over(w), F.lit("Introduction")))
    body = rows.where("not header")
    out = body.groupBy(key, "island", "name").agg(F.array_sort(F.collect_list(F.struct("line", "value"))).alias("l"), F.min("start").alias("start_char"))
    text = F.array_join(F.transform("l", lambda x: x["value"]), "\n")
    return out.select(key, F.col("name").alias("section"), "start_char", (F.col("start_char") + F.length(text)).cast("long").alias("end_char"), text.alias("text")).where(T.strip(F.col("text")) != "")


def headings(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, line, level, number, title, kind, next_line: typed headings; the first kind that fits."""
    rows = lines(docs, key)
    n = rows.groupBy(key).agg(F.max("line").alias("last"))
    v = T.strip(F.col("value"))
    kind, number, title = F.lit(None).cast("string"), F.lit(""), F.lit("")
    for name, p in reversed(HEADINGS):
        hit = v.rlike(p)
        kind = F.when(hit, name).otherwise(kind)
        number = F.when(hit, F.regexp_extract(v, p, 1)).otherwise(number)
        title = F.when(hit, F.regexp_extract(v, p, 2)).otherwise(title)
    out = rows.select(key, "line", kind.alias("kind"), number.alias("number"), title.alias("title")).where("kind is not null")
    level = F.when(F.col("kind") == "sub", F.size(F.split("number", r"\."))).otherwise(F.lit(1))
    w = Window.partitionBy(key).orderBy("line")
    out = out.join(n, key).withColumn("level", level.cast("long")).withColumn("next_line", F.coalesce(F.lead("line").over(w), F.col("last") + 1).cast("long"))
    return out.select(key, F.col("line").cast("long").alias("line"), "level", "number", F.substring("title", 1, 100).alias("title"), "kind", "next_line")


def outline(heads: DataFrame, key: str = "doc_id", depth: int = 5) -> DataFrame:
    """Adds parent_line: the last heading before that has a smaller level."""
    w = Window.partitionBy(key).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    parent = F.lit(None).cast("long")
    for upper in range(1, depth):
        last = F.max(F.when(F.col("level") == upper, F.col("line"))).over(w)
        parent = F.when(F.col("level") > upper, F.greatest(parent, last)).otherwise(parent)
    return heads.withColumn("parent_line", parent)


def structure_issues(heads: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_sections, level_jumps, has_intro, has_conclusion, has_references, valid."""
    jump = F.lead("level").over(Window.partitionBy(key).orderBy("line")) > F.col("level") + 1
    named = lambda p: F.bool_or(F.lower("title").rlike(p))
    out = heads.withColumn("j", F.coalesce(jump, F.lit(False)).cast("int")).groupBy(key).agg(F.count(F.lit(1)).alias("n_sections"), F.sum("j").alias("level_jumps"), named("introduction").alias("has_intro"), named("conclusion").alias("has_conclusion"), named("references|bibliography").alias("has_references"))
    return out.withColumn("valid", (F.col("level_jumps") == 0) & F.col("has_intro"))


def title(text: Column) -> Column:
    """The first of 30 lines that reads like one."""
    ls = F.transform(F.slice(F.split(text, "\n"), 1, 30), T.strip)
    good = lambda x: (F.length(x) > 15) & (F.length(x) < 250) & x.rlike(r"^\p{Lu}") & ~x.rlike(r"\.$") & (x != F.upper(x)) & (F.regexp_count(x, F.lit(":")) <= 1)
    return F.try_element_at(F.filter(ls, good), F.lit(1))


def authors(text: Column) -> Column:
    raw = F.regexp_extract(F.substring(text, 1, 2000), r"(?im)^(?:authors?|by)[ \t]*:?[ \t]+([^\n]{3,300})$", 1)
    return F.slice(F.array_distinct(F.filter(F.transform(F.split(raw, r"[,;]| and "), T.strip), lambda a: a != "")), 1, 10)


def abstract(text: Column) -> Column:
    """struct(text, confidence): the best of several places, checked and weighted; null if none is good enough."""
    head = F.substring(text, 1, 6000)
    places = (
        (F.regexp_extract(head, r"(?is)\babstract\b[ \t:.\-]*\n?(.{50,2000}?)(?=\n[ \t]*(?:1\.?[ \t]+)?introduction\b)", 1), 0.9),
        (F.regexp_extract(head, r"(?is)\babstract\b[ \t:.\-]*\n?(.{50,2000}?)(?=\n[ \t]*keywords?\b)", 1), 0.85),
        (F.regexp_extract(head, r"(?is)\bsummary\b[ \t:.\-]*\n(.{50,2000}?)(?=\n\n)", 1), 0.8),
        (F.regexp_extract(head, r"(?is)\babstract\b[ \t:.\-]*\n?(.{50,2000}?)(?=\n\n|$)", 1), 0.6),
        (F.regexp_extract(head, r"(?s)^(.{50,1500}?)(?=\n\n|$)", 1), 0.5),
    )
    terms = ("propose", "present", "show", "demonstrate", "approach", "method", "results", "paper", "study", "model", "novel", "achieve", "performance", "introduce", "evaluate", "we ", "our ", "data", "algorithm", "problem")

    def checked(place: Column) -> Column:
        t = place["t"]
        hits = T.let(F.lower(t), lambda low: sum((low.contains(x).cast("int") for x in terms), F.lit(0)))
        value = (F.length(t) > 50).cast("double") / 3 + (F.size(T.sentences(t)) >= 1).cast("double") / 3 + F.least(F.lit(1.0), hits / 3) / 3
        fit = lambda v: F.when(v >= 0.5, F.struct((0.7 * place["conf"] + 0.3 * v).alias("confidence"), T.strip(t).alias("text")))
        return F.when(t != "", T.let(value, fit))

    # each place is looked for once, whatever is asked of it
    tried = F.array(*[F.struct(t.alias("t"), F.lit(conf).alias("conf")) for t, conf in places])
    return F.array_max(F.transform(tried, checked))


def mentions(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, kind, number: figures, tables, equations, algorithms and sections that a text mentions, each as often as it does."""
    kinds = {"figure": rf"{T.BEGIN}(?:Figure|Fig\.?) *([0-9]+)", "table": rf"{T.BEGIN}(?:Table|Tab\.) *([0-9]+)", "equation": rf"{T.BEGIN}(?:Equation|Eq\.?) *\(?([0-9]+)", "algorithm": rf"{T.BEGIN}Algorithm *([0-9]+)", "section": rf"{T.BEGIN}Section *([0-9]+)"}

    def of(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)), lambda n: F.struct(F.lit(kind).alias("kind"), n.alias("number")))

    found = [of(k, p) for k, p in kinds.items()]
    return docs.select(key, F.explode(F.concat(*found)).alias("m")).select(key, "m.kind", "m.number")


def captions(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, kind, number, caption: the first line that introduces each element."""
    rows = lines(docs, key)
    p = r"^[ \t]*(Figure|Fig\.?|Table|Tab\.|Equation|Eq\.?|Algorithm|Section) *([0-9]+)[.:][ \t]*([^\n]*)$"
    kind = F.lower(F.substring(F.regexp_extract("value", p, 1), 1, 2))
    full = F.when(kind == "fi", "figure").when(kind == "ta", "table").when(kind == "eq", "equation").when(kind == "al", "algorithm").otherwise("section")
    hit = rows.where(F.col("value").rlike(p)).select(key, full.alias("kind"), F.regexp_extract("value", p, 2).alias("number"), F.struct("line", F.regexp_extract("value", p, 3).alias("c")).alias("r"))
    return hit.groupBy(key, "kind", "number").agg(F.min("r").alias("r")).select(key, "kind", "number", F.col("r.c").alias("caption"))


def resolved(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Mentions with their captions, if the document has them."""
    return mentions(docs, key).join(captions(docs, key), [key, "kind", "number"], "left")


def figure_lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    rows = lines(docs, key)
    p = r"(?i)^[ \t]*(fig(?:ure)?\.?)[ \t]*([0-9]+)[.:]?[ \t]*(.*)$"
    cap = T.strip(F.regexp_extract("value", p, 3))
    return rows.where(F.col("value").rlike(p)).select(key, "line", F.concat(F.lit("Fig "), F.regexp_extract("value", p, 2)).alias("figure"), F.when(cap == "", T.strip(F.col("value"))).otherwise(cap).alias("caption"))


def paper_type(n_sections: Column, title_: Column, pages: Column) -> Column:
    low = F.lower(title_)
    return F.when(low.rlike("survey|review"), "survey").when(low.rlike("technical report"), "technical_report").when(n_sections <= 4, "short_paper").otherwise("research_paper")


@udtf(returnType=StructType().add("kind", "string").add("number", "string").add("title", "string").add("start_line", "integer").add("steps", "integer").add("confidence", "double").add("text", "string"))
class Algorithms:
    """Pseudocode blocks of a text: a header, then lines up to an end mark, a blank line after steps, or 60 lines."""

    HEAD = r"^\s*(Algorithm|Procedure|Function)\s*([0-9]*)\s*[:.]?\s*(.*)$"

    def eval(self, text: str):
        import re

        words = ("for", "while", "if", "else", "return", "repeat", "until", "do", "end", "then")
        rows = (text or "").split("\n")
        i = 0
        while i < len(rows):
            m = re.match(self.HEAD, rows[i])
            if not m:
                i += 1
                continue
            j, body = i + 1, []
            while j < len(rows) and len(body) < 60 and not re.match(self.HEAD, rows[j]) and not (body and not rows[j].strip()):
                if rows[j].strip():
                    body.append(rows[j])
                j += 1
                if re.match(r"\s*end\s+(algorithm|procedure|function)", rows[j - 1], re.I):
                    break
            if len(body) >= 2:
                low = " ".join(body).lower()
                steps = sum(bool(re.match(r"\s*(?:[0-9]+[.:)]|step)", x, re.I)) for x in body)
                io = any(re.match(r"\s*(input|output|require|ensure)", x, re.I) for x in body)
                conf = 0.3 + 0.2 * bool(m[2]) + 0.2 * io + 0.2 * (steps >= 2) + 0.1 * (sum(w in low for w in words) >= 3)
                yield m[1].lower(), m[2], m[3].strip(), i, steps, conf, "\n".join(rows[i:j])
            i = max(j, i + 1)


def reading_minutes(n_words: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n_words / 200)).cast("long")


def voted_lines(parts: DataFrame, key: str, part: str, share: float = 0.7, edge: int = 3) -> DataFrame:
    """Lines among the first or last ``edge`` ones of at least ``share`` of a document's parts (two at least): headers and
    footers. parts: key, part, text."""
    ls = F.transform(F.split("text", "\n"), T.strip)
    ends = F.array_distinct(F.concat(F.slice(ls, 1, edge), F.slice(ls, F.greatest(F.lit(1), F.size(ls) - edge + 1), F.lit(edge))))
    n = parts.groupBy(key).agg(F.countDistinct(part).alias("parts"))
    votes = parts.select(key, part, F.explode(ends).alias("line")).where("line <> ''").groupBy(key, "line").agg(F.countDistinct(part).alias("votes"))
    return votes.join(n, key).where(F.col("votes") >= F.greatest(F.lit(2), F.floor(F.col("parts") * share)))

