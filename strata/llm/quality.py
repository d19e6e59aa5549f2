"""Quality classifier: a sparse ensemble of rules over text statistics.

A shallow forest is grown on a bounded sample of labelled rows; every path from
a root is a conjunctive rule over the statistics.  A lasso logistic regression
weighs the rules and leaves most at zero; the rest compile into one Spark column
expression.  Statistics and score are built-in functions, without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import first_by_hash, null_as_empty, saved

SAMPLE = 20_000          # labelled rows that the model is fitted on, at most
FIT_TASKS = 8            # tasks that each pass of the fit over these rows takes, at most
TREES, DEPTH = 24, 3
LASSO = 0.0015

STATISTICS = ("log_words", "word_length", "longest", "upper", "symbols", "doubled", "bars", "digits",
              "stops", "distinct_words", "repeats", "distinct_lines", "line_words", "short_words")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs plus one double per name in STATISTICS; null and empty texts have
    zero counts, and every ratio over nothing is 0."""
    t = null_as_empty(text_col)
    words = F.filter(F.split(t, r"[\x20\t-\r]+"), lambda w: w != "")
    d = docs.withColumn("__t", t).withColumn("__w", words)
    n = F.greatest(F.char_length("__t"), F.lit(1)).cast("double")
    w = F.greatest(F.size("__w"), F.lit(1)).cast("double")
    lines = F.filter(F.split("__t", "\n"), lambda x: x != "")
    count = lambda pattern: F.regexp_count("__t", F.lit(pattern)).cast("double")
    sizes = F.transform("__w", lambda x: F.char_length(x))
    same = F.zip_with(F.slice("__w", 2, F.greatest(F.size("__w") - 1, F.lit(0))), "__w", lambda a, b: a == b)
    d = d.withColumn("__l", lines).withColumn("__s", sizes)
    n_lines = F.greatest(F.size("__l"), F.lit(1)).cast("double")
    made = {
        "log_words": F.log1p(F.size("__w").cast("double")),
        "word_length": F.char_length("__t") / w,
        "longest": F.coalesce(F.array_max("__s"), F.lit(0)).cast("double"),
        "upper": count(r"\p{Lu}") / n,
        "symbols": count(r"[#&$%*=<>{}\[\]\\~^_@+/]") / n,
        "doubled": count(r"[^\p{L}\p{N}\s]{2,}") / w,
        "bars": count(r"\|") / w,
        "digits": count(r"[0-9]") / n,
        "stops": count(r"[.,;:]") / w,
        "distinct_words": F.size(F.array_distinct("__w")) / w,
        "repeats": F.size(F.filter(same, lambda x: x)) / w,
        "distinct_lines": F.size(F.array_distinct("__l")) / n_lines,
        "line_words": F.size("__w") / n_lines,
        "short_words": F.size(F.filter("__s", lambda x: x <= 3)) / w,
    }
    return d.withColumns({k: made[k].cast("double") for k in STATISTICS}).drop("__t", "__w", "__l", "__s")


Rule = tuple[tuple[str, bool, float], ...]    # (statistic, at most?, threshold), all of which hold


def rule_column(rule: Rule) -> Column:
    out = F.lit(True)
    for name, at_most, threshold in rule:
        out = out & (F.col(name) <= threshold if at_most else F.col(name) > threshold)
    return out


def simplified(rule: Rule) -> Rule:
    """One bound per statistic and direction, in a fixed order."""
    best: dict = {}
    for name, at_most, x in rule:
        had = best.get((name, at_most))
        best[name, at_most] = x if had is None else (min if at_most else max)(had, x)
    return tuple(sorted((n, d, x) for (n, d), x in best.items()))


def paths(node, so_far: Rule = ()) -> list[Rule]:
    """Every path from the root of a fitted tree to another of its nodes."""
    found = [simplified(so_far)] if so_far else []
    if "Internal" in node.getClass().getSimpleName():
        name, x = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        found += paths(node.leftChild(), (*so_far, (name, True, x)))
        found += paths(node.rightChild(), (*so_far, (name, False, x)))
    return found


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1, over columns named as in STATISTICS."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-z))


def fit(rows: DataFrame, label: str = "label", seed: int = 7) -> RuleEnsemble:
    """rows: the STATISTICS and ``label`` (0 or 1).  Without rows of both labels
    the score is their constant share (0.5 without any row)."""
    rows = saved(rows.where(F.col(label).isin(0, 1)).select(F.col(label).cast("double").alias("label"), *STATISTICS))
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if n == 0 or ones in (0, n):
        share = 0.5 if n == 0 else min(max(ones / n, 0.001), 0.999)
        return RuleEnsemble(_logit(share), ())
    # the sample is bounded, the fit reads it some hundred times: a few tasks each time, whatever wrote it
    rows = rows.coalesce(FIT_TASKS)
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(rows)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                    featureSubsetStrategy="sqrt", subsamplingRate=0.7, seed=seed).fit(vectors)
    rules = sorted({r for tree in forest.trees for r in paths(tree._call_java("rootNode"))})
    if not rules:
        return RuleEnsemble(_logit(ones / n), ())
    held = rows.select("label", array_to_vector(F.array(*[rule_column(r).cast("double") for r in rules])).alias("x"))
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=LASSO,
                               maxIter=100, standardization=False).fit(saved(held))
    weights = lasso.coefficients.toArray().tolist()
    return RuleEnsemble(float(lasso.intercept), tuple((r, w) for r, w in zip(rules, weights) if w))


def _logit(p: float) -> float:
    from math import log
    return log(p / (1 - p))


def train_part(id_col: str = "doc_id") -> Column:
    """True for rows that may be learned from: crc32 of the id's text is not a
    multiple of 5 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0, F.lit(False))


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", sample: int = SAMPLE) -> RuleEnsemble:
    """The model from at most ``sample`` labelled rows of the training part, those
    whose id hashes come first: a bound that lets the sample be broadcast.  A label
    that is repeated counts once, and of several documents of an id the smallest
    text, so no more rows than that are fitted."""
    picked = first_by_hash(
        labels.where(train_part(id_col) & F.col(label_col).isin(0, 1))
        .select(F.xxhash64(id_col).alias("hash"), F.col(id_col).alias("key"), F.col(label_col).alias("label")).distinct(),
        ["hash", "key", "label"], sample)
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    one = texts.join(F.broadcast(picked), "key").groupBy("key", "label").agg(F.min(null_as_empty()).alias("text"))
    return fit(statistics(one))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """docs plus held_out, score, predicted (1 from a score of 0.3 on).

    Null and empty texts are scored as texts without words; null ids are held
    out; null labels are not learned from, of several labels of an id each is a
    row; no rows of docs give no rows.  Columns of these names are replaced."""
    model = learned(docs, labels, id_col, text_col, label_col, sample)
    own = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    wide = statistics(docs.select(F.struct(*own).alias("row"), F.col(text_col).alias("text")), "text")
    return wide.select("row.*", (~train_part(f"row.`{id_col}`")).alias("held_out"),
                       model.score().alias("score")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
