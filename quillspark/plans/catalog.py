"""Registered queries: one per operator family of the survey, each reading the
whole test tables (``sf_dir``). Fits, training loops and pinned tokens run
while a query is built; what is returned is a frame over them.

Floating outputs are rounded to a fixed number of significant digits so the
result can be compared with the SQL oracle (plans.oracle) across engines."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.columns import safe_double, sig_round, snippet
from quillspark.operators import gradient as gr
from quillspark.operators import heavy as hv
from quillspark.operators import metrics as mt
from quillspark.operators import profile as pf
from quillspark.operators import text as tx
from quillspark.operators.clean import LINEITEM_KEEP, LINEITEM_RANGES, clean_numeric, clean_observed
from quillspark.operators.index import TextIndex
from quillspark.operators.linear import (
    closed_form,
    fit_sample,
    line_points,
    moments_mse,
    regr,
    regr_view,
    with_previous_loss,
)
from quillspark.plans import classify as cl
from quillspark.plans import descent as ds
from quillspark.plans.certify import certificate
from quillspark.plans.state import StepLog
from quillspark.session import kept_folder, materialize, pin
from quillspark.sources.csv import checked_records, split_records
from quillspark.sources.layout import laid_out
from quillspark.sources.tables import keep_bucketed, read_table
from quillspark.sources.text import BODY_GREEDY, CLASS_ONE_MARK, observe_lines, parse_id_text, parse_labelled

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _rounded(df: DataFrame, digits: int = 9, keep=(), zero_below=None) -> DataFrame:
    """Round every DOUBLE column to ``digits`` significant digits."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double" and f.name not in keep:
            cols.append(sig_round(f.name, digits, zero_below).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- cleaning

ORDER_KEYS = ["l_orderkey", "l_linenumber"]


EXTRA_RANGE = {"tax": (0.02, 0.06)}


def lineitem_clean(spark: SparkSession, sf_dir: str, extra=None) -> DataFrame:
    """lineitem rendered as text, then safe-cast and range-filtered."""
    li = read_table(spark, sf_dir, "lineitem")
    raw = li.select(*ORDER_KEYS, *[F.col(c).cast("string").alias(c) for c in LINEITEM_KEEP.values()])
    return clean_numeric(raw, LINEITEM_KEEP, LINEITEM_RANGES, extra, passthrough=ORDER_KEYS)


@register("safe_range_filter")
def q_safe_range_filter(spark, sf_dir):
    return lineitem_clean(spark, sf_dir)


@register("extra_range_filter")
def q_extra_range_filter(spark, sf_dir):
    return lineitem_clean(spark, sf_dir, EXTRA_RANGE)


@register("rebalanced_filter")
def q_rebalanced_filter(spark, sf_dir):
    """The cleaned rows when the loaded ones are dealt out by size first."""
    li = laid_out(read_table(spark, sf_dir, "lineitem"), "auto")
    raw = li.select(*ORDER_KEYS, *[F.col(c).cast("string").alias(c) for c in LINEITEM_KEEP.values()])
    return clean_numeric(raw, LINEITEM_KEEP, LINEITEM_RANGES, passthrough=ORDER_KEYS)


@register("clean_drop_causes")
def q_clean_drop_causes(spark, sf_dir):
    """Rows in, kept and dropped by cause, counted while the kept ones are
    written; every ninth order has a quantity that is no number."""
    quantity = F.when(F.col("l_orderkey") % 9 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    li = read_table(spark, sf_dir, "lineitem").withColumn("l_quantity", quantity)
    kept, seen = clean_observed(li, LINEITEM_KEEP, LINEITEM_RANGES, passthrough=ORDER_KEYS)
    pin(kept)
    return _counts(spark, seen.get)


def _counts(spark, counts) -> DataFrame:
    """One row of counts."""
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{n} bigint" for n in counts))


RECORD_FIELDS = ["l_orderkey", "l_linenumber", *LINEITEM_KEEP.values(), "l_returnflag"]


def lineitem_records(spark, sf_dir) -> DataFrame:
    """lineitem as delimited lines: every eleventh order's lack the last field,
    every seventeenth's have one more, every thirteenth's price is no number."""
    key = F.col("l_orderkey")
    text = {c: F.col(c).cast("string") for c in RECORD_FIELDS}
    text["l_extendedprice"] = F.when(key % 13 == 0, F.lit("1_000")).otherwise(text["l_extendedprice"])
    line = F.concat_ws(",", *text.values())
    line = F.when(key % 11 == 0, F.concat_ws(",", *list(text.values())[:-1])).when(key % 17 == 0, F.concat(line, F.lit(",x"))).otherwise(line)
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", line.alias("value"))


def _split(spark, sf_dir):
    checked = checked_records(lineitem_records(spark, sf_dir).select(*[F.col(c).alias(f"of_{c}") for c in ORDER_KEYS], "value"),
                              RECORD_FIELDS, LINEITEM_KEEP, LINEITEM_RANGES, passthrough=[f"of_{c}" for c in ORDER_KEYS])
    return split_records(checked, kept_folder(spark, "records"))


@register("reject_table")
def q_reject_table(spark, sf_dir):
    """The lines that aren't kept, with the cause."""
    _, rejects, _ = _split(spark, sf_dir)
    return rejects.select(*[F.col(f"of_{c}").alias(c) for c in ORDER_KEYS], "line", "cause")


@register("reject_counts")
def q_reject_counts(spark, sf_dir):
    """Lines, kept ones and each cause's, counted while both tables were
    written, and the rows that the tables have."""
    kept, rejects, counts = _split(spark, sf_dir)
    return _counts(spark, counts | {"kept_rows": kept.count(), "reject_rows": rejects.count()})


ROW_LIMIT = 5000


@register("row_limit")
def q_row_limit(spark, sf_dir):
    """As many rows as asked for (which ones is the scan's choice), counted."""
    return read_table(spark, sf_dir, "lineitem").limit(ROW_LIMIT).agg(F.count(F.lit(1)).alias("n"))


@register("safe_cast_props")
def q_safe_cast_props(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    k = safe_double(F.get_json_object("props", "$.k"))
    return ev.select("event_id", k.alias("k")).where(F.col("k").isNotNull())


# ---------------------------------------------------------------- regression

@register("ols_closed_form")
def q_ols_closed_form(spark, sf_dir):
    fit = closed_form(lineitem_clean(spark, sf_dir), "quantity", "price")
    return _rounded(fit.select("n", "slope", "intercept"))


@register("ols_regr")
def q_ols_regr(spark, sf_dir):
    return _rounded(regr(lineitem_clean(spark, sf_dir), "quantity", "price"))


@register("ols_view")
def q_ols_view(spark, sf_dir):
    return _rounded(regr_view(lineitem_clean(spark, sf_dir), "quantity", "price"))


@register("mse_at")
def q_mse_at(spark, sf_dir):
    """The fitted line's error and that of slope and intercept 0.1, from one
    row of centred moments: the table is read once."""
    fit = closed_form(lineitem_clean(spark, sf_dir), "quantity", "price")
    return _rounded(fit.select("slope", "intercept", "mse", moments_mse(0.1, 0.1).alias("mse_initial")), 8)


@register("fit_sample")
def q_fit_sample(spark, sf_dir):
    return fit_sample(lineitem_clean(spark, sf_dir), ORDER_KEYS, 1001).select(
        *ORDER_KEYS, "quantity", "price")


@register("line_points")
def q_line_points(spark, sf_dir):
    clean = pin(lineitem_clean(spark, sf_dir).select(*ORDER_KEYS, "quantity", "price"))     # read twice below
    params = regr(clean, "quantity", "price")
    sample = fit_sample(clean, ORDER_KEYS, 1001)
    return _rounded(line_points(sample, params, "quantity", 0.1), 8)


# ---------------------------------------------------------------- parsing


@register("parse_pages")
def q_parse_pages(spark, sf_dir):
    """Pages wrapped as document lines, parsed with the id / shortest-body and
    greedy-body patterns."""
    pages = read_table(spark, sf_dir, "pages")
    lines = pages.select("page_id", F.concat(
        F.lit('<doc id="'), F.col("page_id").cast("string"), F.lit('" url="'), F.col("url"),
        F.lit('">'), F.col("html"), F.lit("</doc>")).alias("value"))
    short = parse_id_text(lines, keep=["page_id", "value"])
    greedy = F.regexp_extract("value", BODY_GREEDY, 1)
    return short.select(
        "page_id", "id",
        F.length("text").cast("bigint").alias("body_len"),
        F.md5("text").alias("body_md5"),
        F.length(greedy).cast("bigint").alias("greedy_len"),
        F.col("value").contains(CLASS_ONE_MARK).alias("is_class_one"),
        snippet("text").alias("snippet"),
    )


def marked_lines(spark, sf_dir) -> DataFrame:
    """Labelled documents written as marked lines: class 1 (toxic) ids start
    with AU."""
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    prefix = F.when(F.col("toxic") == 1, F.lit("AU")).otherwise(F.lit("XX"))
    return docs.join(labels, "doc_id").select("doc_id", F.concat(
        F.lit('<doc id="'), prefix, F.col("doc_id").cast("string"), F.lit('" title="t">'),
        F.col("text"), F.lit("</doc>")).alias("value"))


@register("parse_counts")
def q_parse_counts(spark, sf_dir):
    """Of lines of which some lack the end mark: how many parse."""
    lines = marked_lines(spark, sf_dir).select(
        F.when(F.col("doc_id") % 7 == 0, F.expr("left(value, length(value) - 3)")).otherwise(F.col("value")).alias("value"))
    seen_lines, seen = observe_lines(lines)
    pin(parse_labelled(seen_lines, with_id=False).select("label", F.length("text").alias("n_chars")))
    return _counts(spark, seen.get)


@register("parse_marked_docs")
def q_parse_marked_docs(spark, sf_dir):
    parsed = parse_labelled(marked_lines(spark, sf_dir))
    return parsed.select(F.substring("doc_id", 3, 20).cast("bigint").alias("doc_id"), "label", F.length("text").cast("bigint").alias("body_len"),
                         F.md5("text").alias("body_md5"))


# ---------------------------------------------------------------- text features


DIM = 2000        # words of a vocabulary
TOP_K = 20


def documents(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def corpus(spark, sf_dir) -> DataFrame:
    """The documents' tokens, pinned: fit and features read them, the texts
    are read once."""
    return pin(tx.tokenised(documents(spark, sf_dir)))


@register("doc_freq")
def q_doc_freq(spark, sf_dir):
    return tx.doc_freq(documents(spark, sf_dir))


def _vocab_query(rule):
    def fn(spark, sf_dir):
        return tx.fit_vocabulary(corpus(spark, sf_dir), DIM, rule=rule).words()
    return fn


register("vocab_not_all")(_vocab_query(tx.RULE_NOT_ALL))
register("vocab_forced")(_vocab_query(tx.RULE_FORCED))
register("vocab_max_df")(_vocab_query(tx.RULE_MAX_DF))


def _summary_query(rule):
    """The same vocabularies from bounded summaries; counting every distinct
    word is what happens only where the proof fails."""
    def fn(spark, sf_dir):
        vocab, _ = hv.fit_vocabulary(corpus(spark, sf_dir), DIM, rule=rule)
        return vocab.words()
    return fn


register("vocab_summary_not_all")(_summary_query(tx.RULE_NOT_ALL))
register("vocab_summary_forced")(_summary_query(tx.RULE_FORCED))
register("vocab_summary_max_df")(_summary_query(tx.RULE_MAX_DF))


@register("term_freq")
def q_term_freq(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    return _rounded(tx.term_freq(docs, tx.fit_vocabulary(docs, DIM)), 9)


@register("tfidf")
def q_tfidf(spark, sf_dir):
    docs = corpus(spark, sf_dir)
    return _rounded(tx.tfidf_long(docs, tx.fit_vocabulary(docs, DIM)), 9)


def first_benchmark_text(spark, sf_dir) -> DataFrame:
    """The query text: the benchmark item with the smallest id (one row)."""
    return read_table(spark, sf_dir, "benchmark").orderBy("item_id").limit(1).select("text")


@register("topk_similar_docs")
def q_topk_similar_docs(spark, sf_dir):
    tokens = corpus(spark, sf_dir)
    vocab = tx.fit_vocabulary(tokens, DIM)
    return tx.top_k_similar_text(documents(spark, sf_dir), vocab, first_benchmark_text(spark, sf_dir), TOP_K, tokens=tokens)


@register("topk_kept_vectors")
def q_topk_kept_vectors(spark, sf_dir):
    """Fit once, keep the vectors, then query them."""
    tokens = corpus(spark, sf_dir)
    vocab = tx.fit_vocabulary(tokens, DIM)
    kept = pin(tx.features(tokens, vocab))
    query = tx.dense_query(tx.vectorize_text(spark, first_benchmark_text(spark, sf_dir), vocab), DIM)
    return tx.top_k_similar(kept, query, TOP_K, docs=documents(spark, sf_dir))


def text_index(spark, sf_dir) -> TextIndex:
    """The corpus' kept inverted index, in a new folder."""
    return TextIndex.build(documents(spark, sf_dir), kept_folder(spark, "index"), DIM)


@register("topk_indexed")
def q_topk_indexed(spark, sf_dir):
    """The flagship's hits, from the postings of the query's words alone."""
    query = first_benchmark_text(spark, sf_dir).select(F.lit(0).alias("query"), "text")
    return text_index(spark, sf_dir).top_k(query, TOP_K).select("rank", "doc_id", "score", "snippet")


@register("topk_all_texts")
def q_topk_all_texts(spark, sf_dir):
    """The hits of every benchmark text, one index and one plan for all."""
    queries = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), "text")
    return text_index(spark, sf_dir).top_k(queries, TOP_K).select(F.col("query").alias("item_id"), "rank", "doc_id", "score", "snippet")


# ---------------------------------------------------------------- classes


CLASS_PROFILE_N = 40
LAMBDA = 0.01
THETA0 = 0.1
GRAD_ZERO = 1e-12  # |gradient| below this is rounding noise of an exact zero


def labels(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))


def labelled_corpus(spark, sf_dir) -> DataFrame:
    """``(doc_id, label, is_test, n_tok, words, counts)``, pinned: the tokens
    of the documents with a label row; class 1 = toxic. Texts are tokenised in
    the scan; it is the tokens that meet the labels, by the id on both sides.
    Spark picks the join from the sizes at run time (AQE), no broadcast is
    forced because the label table grows with the corpus."""
    tokens = tx.tokenised(documents(spark, sf_dir))
    return pin(pf.split_flag(tokens.join(labels(spark, sf_dir), "doc_id")))


def labelled_ids(spark, sf_dir) -> DataFrame:
    """The ids, labels and split of the labelled documents that have a text."""
    ids = read_table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id")
    return pf.split_flag(ids.join(labels(spark, sf_dir), "doc_id"))


@register("label_token_stats")
def q_label_token_stats(spark, sf_dir):
    """Documents, tokens and distinct words per class, from token and label
    tables that are kept in equal buckets by id: their join moves no rows."""
    tokens = keep_bucketed(tx.tokenised(documents(spark, sf_dir)), "doc_id")
    known = keep_bucketed(labels(spark, sf_dir), "doc_id")
    return tokens.join(known.hint("merge"), "doc_id").groupBy("label").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_tok").alias("n_tok"), F.sum(F.size("words")).alias("n_words"))


@register("class_mean_tf")
def q_class_mean_tf(spark, sf_dir):
    ld = labelled_corpus(spark, sf_dir)
    vocab = tx.fit_vocabulary(ld, DIM, rule=tx.RULE_FORCED)
    return _rounded(pf.class_mean_tf(ld, vocab, CLASS_PROFILE_N), 9)


@register("stable_split")
def q_stable_split(spark, sf_dir):
    return labelled_ids(spark, sf_dir).select("doc_id", "label", "is_test")


@register("label_counts")
def q_label_counts(spark, sf_dir):
    return pf.label_counts(labelled_ids(spark, sf_dir).where("NOT is_test")).select("label", "n")


@register("class_weights")
def q_class_weights(spark, sf_dir):
    return _rounded(pf.class_weights(labelled_ids(spark, sf_dir).where("NOT is_test")), 12)


def model_inputs(spark, sf_dir, rule, dim=DIM):
    """Vocabulary fitted on the train split, and the sparse features of both
    splits (``is_test``) with the train statistics."""
    vocab, feats, _ = weighted_inputs(spark, sf_dir, rule, dim, weighted=False)
    return vocab, feats


def weighted_inputs(spark, sf_dir, rule, dim=DIM, weighted=True):
    """The same with the class shares of the train split, which are counted on
    the pinned tokens: only their labels are read for that."""
    tokens = labelled_corpus(spark, sf_dir)
    train = tokens.where("NOT is_test")
    vocab = tx.fit_vocabulary(train, dim, rule=rule)
    shares = pf.class_shares(train) if weighted else None
    return vocab, tx.features(tokens, vocab, keep=["label", "is_test"]), shares


def train_part(feats: DataFrame) -> DataFrame:
    return feats.where("NOT is_test")


def split_name():
    return F.when(F.col("is_test"), "test").otherwise("train").alias("split")


KIND_RULE = {"logistic": tx.RULE_FORCED, "hinge": tx.RULE_MAX_DF,
             "weighted_hinge": tx.RULE_MAX_DF}


def _loss_query(kind):
    def fn(spark, sf_dir):
        vocab, feats, shares = weighted_inputs(spark, sf_dir, KIND_RULE[kind], weighted=kind == "weighted_hinge")
        theta = np.full(vocab.size() + 1, THETA0)
        m = mt.with_margin(train_part(feats).select("label", "i", "v"), theta)
        w = None
        if shares:
            w = F.when(F.col("label") == 1.0, shares[1.0]).otherwise(shares[0.0])
        out = m.agg(F.count(F.lit(1)).alias("n"),
                    F.avg(gr.loss_col(kind, F.col("margin"), F.col("label"), w)).alias("loss"))
        if kind == "logistic":
            reg = float(theta @ theta) * LAMBDA / 2.0
            out = out.select("n", (F.col("loss") + F.lit(reg) / F.col("n")).alias("loss"))
        return _rounded(out, 9)
    return fn


def _grad_query(kind):
    def fn(spark, sf_dir):
        vocab, feats, shares = weighted_inputs(spark, sf_dir, KIND_RULE[kind], weighted=kind == "weighted_hinge")
        p = vocab.size() + 1
        train = train_part(feats)
        g, _, n = gr.gradient_and_loss(train, np.full(p, THETA0), kind, "exact", shares=shares)
        g = g / n + (LAMBDA * THETA0 / n if kind == "logistic" else 0.0)
        out = spark.createDataFrame([(k, float(x)) for k, x in enumerate(g)], "idx int, grad double")   # at most dim + 1 rows
        return _rounded(out, 9, zero_below=GRAD_ZERO)
    return fn


for _kind in ("logistic", "hinge", "weighted_hinge"):
    register(f"{_kind}_loss")(_loss_query(_kind))
    register(f"{_kind}_grad")(_grad_query(_kind))


def _confusion_at_theta0(spark, sf_dir):
    vocab, feats = model_inputs(spark, sf_dir, tx.RULE_FORCED)
    pred = mt.predict(feats, np.full(vocab.size() + 1, THETA0), mt.LOGISTIC_THRESHOLD)
    return mt.confusion(pred, by=("is_test",)).select(split_name(), "tp", "fn", "fp", "tn")


@register("predict_confusion")
def q_predict_confusion(spark, sf_dir):
    return _confusion_at_theta0(spark, sf_dir)


@register("accuracy_f1")
def q_accuracy_f1(spark, sf_dir):
    return _rounded(mt.accuracy_f1(_confusion_at_theta0(spark, sf_dir)), 12)


# ---------------------------------------------------------------- descent


MULTI_X = ["quantity", "discount", "tax"]


def _simple_trace_query(variant):
    """Slope, intercept and mean squared error per step, in the data's units."""
    def fn(spark, sf_dir):
        tr = ds.simple_trace(lineitem_clean(spark, sf_dir), "quantity", "price", variant)
        return _rounded(with_previous_loss(tr).select(
            "step", "loss", "loss_old", "learning_rate", F.col("theta")[0].alias("m"), F.col("theta")[1].alias("b")), 9)
    return fn


def _multi_trace_query(variant):
    """As above for several features. The observed rule works on raw inputs,
    where it needs a target of the features' size: prices in thousands."""
    def fn(spark, sf_dir):
        rows = lineitem_clean(spark, sf_dir)
        if variant == "observed":
            rows = rows.withColumn("price", F.col("price") / 1000.0)
        tr = ds.multi_trace(rows, MULTI_X, "price", variant)
        ws = [F.col("theta")[j].alias(f"w_{x}") for j, x in enumerate(MULTI_X)]
        return _rounded(with_previous_loss(tr).select(
            "step", "loss", "loss_old", "learning_rate", *ws, F.col("theta")[len(MULTI_X)].alias("w_const")), 9)
    return fn


register("gd_simple_trace")(_simple_trace_query("exact"))
register("gd_simple_observed")(_simple_trace_query("observed"))
register("gd_multi_trace")(_multi_trace_query("exact"))
register("gd_multi_observed")(_multi_trace_query("observed"))


# ---------------------------------------------------------------- classifiers


STEPS = 20
BREAK_AFTER = 7


def _trained(spark, sf_dir, kind, steps=STEPS, variant="exact", evaluate=False, dim=DIM, broken_after=None):
    """Train on the pinned train features. With ``evaluate``, also score the
    final θ on train and test, both in one pass over the pinned features,
    before releasing them; the result is two small rows. With ``broken_after``
    the run ends after that step, and another one goes on from its log."""
    vocab, feats = model_inputs(spark, sf_dir, KIND_RULE[kind], dim)
    p = vocab.size() + 1
    feats = materialize(feats)
    try:
        train = train_part(feats)
        shares = pf.class_shares(train) if kind == "weighted_hinge" else None
        path = kept_folder(spark, "training") if broken_after else None
        for last in [broken_after, steps] if broken_after else [steps]:
            log = StepLog(spark, path, {"kind": kind, "variant": variant, "p": p}) if path else None
            if kind == "logistic":
                fit = cl.train_logistic(train, p, variant, max_iter=last, log=log)
            else:
                fit = cl.train_hinge(train, p, dim, variant, shares=shares, max_iter=last, log=log)
        scores = None
        if evaluate:
            thr = mt.LOGISTIC_THRESHOLD if kind == "logistic" else mt.HINGE_THRESHOLD
            both = cl.evaluate(feats, fit.theta, thr, by=("is_test",)).select(split_name(), "tp", "fn", "fp", "tn", "accuracy", "f1")
            scores = spark.createDataFrame(both.collect(), both.schema)       # two rows
    finally:
        feats.unpersist()
    return fit, scores


def _trace_query(kind, variant="exact", broken_after=None):
    def fn(spark, sf_dir):
        fit, _ = _trained(spark, sf_dir, kind, variant=variant, broken_after=broken_after)
        return _rounded(fit.trace_frame(spark), 9)
    return fn


def _eval_query(kind, variant="exact"):
    """Train, then confusion, accuracy and F1 of the final θ on the train and
    test splits (logistic: margin >= 0.5; hinge: >= 0)."""
    def fn(spark, sf_dir):
        _, scores = _trained(spark, sf_dir, kind, variant=variant, evaluate=True)
        return _rounded(scores, 12)
    return fn


for _name, _kind in (("logistic", "logistic"), ("svm", "hinge"), ("weighted_svm", "weighted_hinge")):
    register(f"{_name}_trace")(_trace_query(_kind))
    register(f"{_name}_trace_observed")(_trace_query(_kind, "observed"))
    register(f"{_name}_eval")(_eval_query(_kind))
    register(f"{_name}_eval_observed")(_eval_query(_kind, "observed"))
    # a run that ended after step 7, and one that went on from what it kept
    register(f"{_name}_trace_resumed")(_trace_query(_kind, "observed" if _kind == "hinge" else "exact", broken_after=BREAK_AFTER))
    # an earlier name of the same
    register(f"{_name}_eval_full")(QUERIES[f"{_name}_eval"])
    if _name != "weighted_svm":
        register(f"{_name}_trace_full")(QUERIES[f"{_name}_trace"])


def _svc_facts(feats: DataFrame, theta) -> DataFrame:
    """What is determined of a library fit: rows and classes of each split, and
    that the fitted mean hinge loss on train is below that of θ = 0, which is 1."""
    m = mt.with_margin(feats, theta)
    loss = F.avg(F.when(~F.col("is_test"), gr.loss_col("hinge", F.col("margin"), F.col("label")))).alias("loss")
    out = m.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1.0).alias("positives"),
        F.count_if(F.col("label") == 0.0).alias("negatives"), loss)
    return out.select(split_name(), "n", "positives", "negatives", (F.col("loss") < 1.0).alias("below_start"))


@register("linear_svc")
def q_linear_svc(spark, sf_dir):
    """Spark ML LinearSVC on the embeddings (class = label mod 2), fitted on
    the train split by id."""
    emb = pf.split_flag(read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("v"),
        F.pmod(F.col("label"), F.lit(2)).cast("double").alias("label")))
    _, theta = cl.linear_svc(cl.dense_features(emb.where("NOT is_test"), "v"))
    idx = F.sequence(F.lit(0), F.lit(len(theta) - 2))
    return _svc_facts(emb.withColumn("i", idx), theta)


@register("linear_svc_tfidf")
def q_linear_svc_tfidf(spark, sf_dir):
    """Spark ML LinearSVC on the sparse TF-IDF vectors of the labelled
    documents (vocabulary rule of the hinge models, fitted on the train split)."""
    vocab, feats = model_inputs(spark, sf_dir, KIND_RULE["hinge"])
    feats = materialize(feats)
    try:
        _, theta = cl.linear_svc(cl.sparse_vectors(train_part(feats), vocab.size()))
        both = _svc_facts(feats, theta)
        return spark.createDataFrame(both.collect(), both.schema)             # two rows
    finally:
        feats.unpersist()


SVC_REG = 1e-3
SVC_GAP = 0.02        # of the objective: what a better fit could gain at most


@register("svc_certified")
def q_svc_certified(spark, sf_dir):
    """The library classifier with a penalty: its scores at margin 0.5 on both
    splits, and whether its objective on train is proven to be within
    ``SVC_GAP`` of the least there is."""
    vocab, feats = model_inputs(spark, sf_dir, KIND_RULE["hinge"])
    feats = materialize(feats)
    try:
        train = train_part(feats)
        _, theta = cl.linear_svc(cl.sparse_vectors(train, vocab.size()), reg_param=SVC_REG, standardize=False)
        proof = certificate(train, theta, SVC_REG)
        scores = cl.evaluate(feats, theta, mt.LOGISTIC_THRESHOLD, by=("is_test",)).select(
            split_name(), "tp", "fn", "fp", "tn", "accuracy", "f1",
            F.when(~F.col("is_test"), F.lit(proof.within(SVC_GAP))).alias("certified"))
        return _rounded(spark.createDataFrame(scores.collect(), scores.schema), 12)          # two rows
    finally:
        feats.unpersist()
