"""Questions and answers: query expansion and smoke cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Unicode word boundaries around a phrase
_BEFORE, _AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def boundary(phrase: Column) -> Column:
    """A pattern for a phrase as whole words."""
    return F.concat(F.lit(_BEFORE), F.regexp_replace(phrase, r"([\\.\[\]{}()*+?^$|])", r"\\$1"), F.lit(_AFTER))


def exploded(maps: DataFrame) -> DataFrame:
    """(pack_id, ord, phrase, terms) of maps (pack_id, query_expansion), in the map's order."""
    return maps.select("pack_id", F.posexplode(F.map_entries("query_expansion")).alias("ord", "e")).select("pack_id", "ord", F.col("e.key").alias("phrase"), F.col("e.value").alias("terms"))


#: what an index of phrases is made of: words, and other characters one by one
_PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"


def pieces(text: Column) -> Column:
    """The distinct words of a text, and its other characters one by one."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)))


def indexed(phrases: DataFrame) -> DataFrame:
    """phrases with the piece by which each is found: of its words (other characters where it has none) the one in the fewest phrases, then the longest, then the first in order.

    A phrase stands as whole words only where each of its words stands as a whole word, so any of them will
    do; the rarest keeps a word that many phrases share from gathering them all.  Empty phrases and
    nulls have no piece and are left out.
    """
    rows = phrases.select(F.struct(*phrases.columns).alias("_p"), F.explode(pieces(F.col("phrase"))).alias("piece"))
    counts = phrases.select("phrase").distinct().select(F.explode(pieces(F.col("phrase"))).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(~F.rlike("piece", F.lit(r"[\p{L}\p{N}_]")), "n", -F.length("piece"), "piece")
    best = rows.join(counts, "piece").groupBy("_p").agg(F.min_by("piece", order).alias("piece"))
    return best.select("_p.*", "piece")


def hits(questions: DataFrame, phrases: DataFrame) -> DataFrame:
    """questions (question_id, question) with the phrases (ord, phrase, terms) that stand in them as whole words; repeated rows of phrases count once, empty phrases stand nowhere.

    An equi-join on one piece of each phrase brings the candidates, which the pattern then verifies: work grows with
    questions' words and with what they meet, not with questions times phrases.
    """
    low = questions.withColumn("_low", F.lower("question"))
    return low.withColumn("piece", F.explode(pieces(F.col("_low")))).join(indexed(phrases), "piece").filter(F.regexp_like("_low", boundary(F.col("phrase")))).drop("piece")


def expand(questions: DataFrame, phrases: DataFrame) -> DataFrame:
    """(question_id, question, terms): what the vocabulary adds to each question, in order.

    Longest phrases first, then by their order; a term that stands in the question, or came before in any
    case, is not added.  Questions without an addition have an empty list.
    """
    found = hits(questions, phrases).select("question_id", "_low", F.length("phrase").alias("size"), "ord", F.posexplode("terms").alias("pos", "term"))
    found = found.filter(~F.contains("_low", F.lower("term"))).withColumn("_t", F.lower("term"))
    order = Window.partitionBy("question_id", "_t").orderBy(F.desc("size"), "ord", "pos")
    found = found.withColumn("_n", F.row_number().over(order)).filter("_n = 1")
    added = found.groupBy("question_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("s"), "ord", "pos", "term"))), lambda x: x["term"]).alias("terms"))
    return questions.select("question_id", "question").join(added, "question_id", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))


def valid_map(expansion: Column) -> Column:
    """Whether keys are lower case and values lists, not empty, of terms that are not blank."""
    return F.forall(F.map_entries(expansion), lambda e: (e["key"] == F.lower(e["key"])) & (F.size(e["value"]) > 0) & F.forall(e["value"], lambda t: F.coalesce(F.trim(t) != "", F.lit(False))))


#: How an answer says that it has none, for cases that must be answered.
BLANKET = r"(?i)\b(?:i (?:do not|don't|cannot|can't) (?:know|find|answer)|no (?:relevant )?(?:information|documents?|results?) (?:is |are |was |were )?(?:available|found)|not (?:available|found|covered) in (?:the|any) (?:provided |available )?(?:documents?|sources?|corpus|context))"


def smoke(answers: DataFrame) -> DataFrame:
    """answers with passed: every wanted pattern occurs, no unwanted one does, in any case, and what is expected of the answer as a whole holds.

    answers: id, answer, contains, not_contains; and, where they are known, answered and gated (what the
    runner saw) against expect_answered and expect_gated, and no_blanket_absence: the answer must not
    say that there is nothing.  A null expectation asks for nothing.
    """
    says = lambda p: F.regexp_like(F.col("answer"), F.concat(F.lit("(?i)"), p))
    none = F.array().cast("array<string>")
    passed = F.forall(F.coalesce("contains", none), says) & F.forall(F.coalesce("not_contains", none), lambda p: ~says(p))
    for flag in ("answered", "gated"):
        if {flag, f"expect_{flag}"} <= set(answers.columns):
            passed = passed & (F.col(f"expect_{flag}").isNull() | F.col(flag).eqNullSafe(F.col(f"expect_{flag}")))
    if "no_blanket_absence" in answers.columns:
        passed = passed & ~(F.coalesce("no_blanket_absence", F.lit(False)) & F.coalesce(F.rlike("answer", F.lit(BLANKET)), F.lit(False)))
    return answers.withColumn("passed", F.coalesce(passed, F.lit(False)))


def evaluated(cases: DataFrame, answers: DataFrame) -> DataFrame:
    """smoke() of cases (id, category, expect) joined with a runner's answers (id, answer, answered, gated); a case without an answer fails."""
    e = lambda c: F.col(f"expect.{c}")
    rows = cases.join(answers, "id", "left").select("id", "category", F.coalesce("answer", F.lit("")).alias("answer"), "answered", "gated", e("answered").alias("expect_answered"), e("gated").alias("expect_gated"), e("no_blanket_absence").alias("no_blanket_absence"), e("contains").alias("contains"), e("not_contains").alias("not_contains"))
    return smoke(rows).select("id", "category", "passed")
