"""Secret scans over an incremental ledger of content-addressed texts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.llm.common import stage


@dataclass(frozen=True)
class Rule:
    """A pattern; if ``least`` is set, matches count whose ``group`` has that many characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0


# Fixed by the contract, in the order in which kinds are listed. For the last two the least length is part of the
# pattern: each ends in one greedy class, so a run too short from its first start is too short from any later one.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
MASK = "[removed]"
#: Characters in one piece of a text that masks are put into.
PIECE = 1024


def blob_id(text: Column) -> Column:
    """The address of a content: SHA-256 of its bytes, a missing text being the empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def match_sizes(text: Column, rule: Rule) -> Column:
    """The gap before each of a rule's leftmost non-overlapping matches, its size, and whether it counts.

    Splitting by the pattern gives the gaps and extracting gives the matches; where a match lies is the sum of all
    sizes up to it, which :func:`scan_unseen` takes over rows, as sums inside an array would be quadratic.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.least else whole
    gaps = F.slice(F.split(text, rule.pattern, -1), 1, F.size(whole))
    found = F.zip_with(whole, judged, lambda m, g: F.struct(F.length(m).alias("size"), (F.length(g) >= rule.least).alias("counts")))
    sizes = F.zip_with(gaps, found, lambda gap, x: F.struct(F.length(gap).alias("gap"), x["size"].alias("size"), x["counts"].alias("counts")))
    return F.when(F.rlike(text, pattern), sizes).otherwise(F.array().cast("array<struct<gap:int,size:int,counts:boolean>>"))


def scan_unseen(blobs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (``blob``, ``kind``, ``version``, ``spans``) of the pairs that ``ledger`` doesn't hold yet.

    ``blobs`` has distinct (``blob``, ``text``). Only texts with an unseen
    (blob, rule version) pair are read by a pattern, and only by the rules they miss.
    """
    if ledger is None:
        pending = blobs.withColumn("_todo", F.array(*[F.lit(r.kind) for r in rules]))
    else:
        wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
        pairs = blobs.select("blob", F.explode(wanted).alias("_r")).select("blob", "_r.kind", "_r.version")
        unseen = pairs.join(ledger.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
        todo = unseen.groupBy("blob").agg(F.collect_set("kind").alias("_todo"))
        pending = blobs.join(todo, "blob")
    found = pending.select("blob", F.explode(F.array(*[
        F.when(F.array_contains("_todo", r.kind), F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), match_sizes(F.col("text"), r).alias("sizes")))
        for r in rules])).alias("_f")).filter(F.col("_f").isNotNull())
    # A row a match, and one for a pair without any; positions are running sums over the rows of a pair.
    each = found.select("blob", "_f.kind", "_f.version", F.posexplode_outer("_f.sizes").alias("_n", "_m"))
    end = F.sum(F.col("_m.gap") + F.col("_m.size")).over(W.partitionBy("blob", "kind", "version").orderBy("_n"))
    placed = each.withColumn("_end", end.cast("int"))
    span = F.struct((F.col("_end") - F.col("_m.size")).alias("start"), F.col("_end").alias("end"))
    return placed.groupBy("blob", "kind", "version").agg(
        F.array_sort(F.collect_list(F.when(F.col("_m.counts"), span))).alias("spans"))  # the matches of one text


def scan_history(versions: DataFrame, ledger: DataFrame | None = None,
                 rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Scan every version (a row with ``text``) once per content and rule version.

    Returns the rows of ``versions`` with ``blob`` and ``findings`` (array of
    (start, rank, end, kind, covered) by start, then kind as listed; ``covered`` is how far earlier ones reach), and
    the ledger rows that are new. Each content is shuffled and scanned once however many rows hold
    it; findings go back to all of them by its address. Known pairs come from
    ``ledger``. A null text is the empty content, which has no findings; repeated rows are kept; input columns named
    ``blob`` or ``findings`` are replaced; an empty table gives empty ones. The work grows in proportion to a text's
    length and its matches, which travel as rows; a text is one value in its task.
    """
    paths = versions.drop("blob", "findings").withColumn("blob", blob_id(F.col("text")))
    blobs = paths.select("blob", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["blob"])
    fresh = stage(scan_unseen(blobs, ledger, rules), "secret-ledger")
    known = fresh if ledger is None else fresh.unionByName(ledger.select("blob", "kind", "version", "spans"))
    rank = reduce(lambda c, n: c.when((F.col("kind") == rules[n].kind) & (F.col("version") == rules[n].version), n),
                  range(1, len(rules)), F.when((F.col("kind") == rules[0].kind) & (F.col("version") == rules[0].version), 0))
    spans = known.withColumn("rank", rank).filter("rank is not null").select("blob", "kind", "rank", F.inline("spans"))
    ahead = W.partitionBy("blob").orderBy("start", "rank", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("covered", F.coalesce(F.max("end").over(ahead), F.lit(0)))
    per_blob = spans.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind", "covered"))).alias("findings"))
    none = F.array().cast(per_blob.schema["findings"].dataType)
    joined = paths.join(per_blob, "blob", "left")
    return joined.withColumn("findings", F.coalesce("findings", none)), fresh


def masked(text: Column, findings: Column, mask: str = MASK) -> Column:
    """The text with every found span replaced; overlapping spans are replaced together.

    A finding that starts beyond what is ``covered`` before it puts the text between and one mask. Stretches are cut
    from pieces of the text, as looking up a position in a long text reads it from its start.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def build(cut: Column) -> Column:
        def stretch(a: Column, b: Column) -> Column:
            first, last = F.floor(a / PIECE).cast("int"), F.floor(b / PIECE).cast("int")
            head, tail = F.get(cut, first), F.coalesce(F.get(cut, last), F.lit(""))
            inside = F.substring(head, F.pmod(a, F.lit(PIECE)) + 1, b - a)
            across = F.concat(F.substring(head, F.pmod(a, F.lit(PIECE)) + 1, F.lit(PIECE)),
                              F.array_join(F.slice(cut, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                              F.substring(tail, F.lit(1), F.pmod(b, F.lit(PIECE))))
            return F.when(b <= a, "").when(first == last, inside).otherwise(across)

        parts = F.transform(findings, lambda f: F.when(
            f["start"] >= f["covered"], F.concat(stretch(f["covered"], f["start"]), F.lit(mask))).otherwise(""))
        end = F.array_max(F.transform(findings, lambda f: f["end"]))
        return F.concat(F.array_join(parts, ""), stretch(end, F.length(text)))

    done = F.get(F.transform(F.array(pieces), build), F.lit(0))
    return F.when(F.size(findings) > 0, done).otherwise(text)
