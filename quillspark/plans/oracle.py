"""SQL oracles: for each registered query, the same result as ANSI SQL over
the pre-registered table views (DuckDB dialect)."""

from __future__ import annotations

from quillspark.operators.clean import LINEITEM_KEEP, LINEITEM_RANGES
from quillspark.operators.metrics import HINGE_THRESHOLD, LOGISTIC_THRESHOLD
from quillspark.operators.text import FORCED_WORDS
from quillspark.plans.catalog import (
    CLASS_PROFILE_N,
    DIM,
    EXTRA_RANGE,
    KIND_RULE,
    LAMBDA,
    MULTI_X,
    ROW_LIMIT,
    STEPS,
    THETA0,
    TOP_K,
)
from quillspark.plans.sqltext import sql_safe_double, sql_sig_round, sql_str
from quillspark.sources.text import BODY_GREEDY, BODY_SHORTEST, CLASS_ONE_MARK, ID_PATTERN

ORACLES: dict[str, str] = {}


def _lineitem_clean_sql(extra=()) -> str:
    parsed = ",\n  ".join(f"{sql_safe_double(src)} AS {name}" for name, src in LINEITEM_KEEP.items())
    conds = [f"{n} BETWEEN {float(lo)!r} AND {float(hi)!r}" for n, (lo, hi) in {**LINEITEM_RANGES, **dict(extra)}.items()]
    conds += [f"{n} IS NOT NULL" for n in LINEITEM_KEEP]
    return (f"(SELECT * FROM (SELECT l_orderkey, l_linenumber,\n  {parsed}\n FROM lineitem) p\n"
            f" WHERE {' AND '.join(conds)})")


LI = _lineitem_clean_sql()
R = sql_sig_round

ORACLES["safe_range_filter"] = f"SELECT * FROM {LI} c"

ORACLES["safe_cast_props"] = f"""
SELECT event_id, k FROM (
  SELECT event_id, {sql_safe_double("json_extract_string(props, '$.k')")} AS k FROM events) e
WHERE k IS NOT NULL"""

ORACLES["extra_range_filter"] = f"SELECT * FROM {_lineitem_clean_sql(EXTRA_RANGE)} c"

ORACLES["rebalanced_filter"] = ORACLES["safe_range_filter"]

_IN_RANGE = " AND ".join(f"{LINEITEM_KEEP[n]} BETWEEN {float(lo)!r} AND {float(hi)!r}" for n, (lo, hi) in LINEITEM_RANGES.items())

ORACLES["clean_drop_causes"] = f"""
SELECT count(*) AS rows_in, count(*) FILTER (WHERE l_orderkey % 9 <> 0 AND {_IN_RANGE}) AS rows_kept,
       count(*) FILTER (WHERE l_orderkey % 9 = 0) AS unparsable,
       count(*) FILTER (WHERE l_orderkey % 9 <> 0 AND NOT ({_IN_RANGE})) AS out_of_range FROM lineitem"""

_CAUSE = f"""SELECT *, CASE WHEN l_orderkey % 11 = 0 OR l_orderkey % 17 = 0 THEN 'ragged' WHEN l_orderkey % 13 = 0 THEN 'unparsable'
               WHEN NOT ({_IN_RANGE}) THEN 'out_of_range' END AS cause FROM lineitem"""
_RECORD = ("concat_ws(',', l_orderkey, l_linenumber, l_quantity, CASE WHEN l_orderkey % 13 = 0 THEN '1_000' ELSE l_extendedprice::VARCHAR END, "
           "l_discount, l_tax, CASE WHEN l_orderkey % 11 <> 0 THEN l_returnflag END, CASE WHEN l_orderkey % 11 <> 0 AND l_orderkey % 17 = 0 THEN 'x' END)")

ORACLES["reject_table"] = f"""
SELECT l_orderkey, l_linenumber, {_RECORD} AS line, cause FROM ({_CAUSE}) c WHERE cause IS NOT NULL"""

ORACLES["reject_counts"] = f"""
SELECT count(*) AS lines, count(*) FILTER (WHERE cause IS NULL) AS kept, count(*) FILTER (WHERE cause = 'ragged') AS ragged,
       count(*) FILTER (WHERE cause = 'unparsable') AS unparsable, count(*) FILTER (WHERE cause = 'out_of_range') AS out_of_range,
       count(*) FILTER (WHERE cause IS NULL) AS kept_rows, count(cause) AS reject_rows FROM ({_CAUSE}) c"""

ORACLES["row_limit"] = f"SELECT count(*) AS n FROM (SELECT 1 FROM lineitem LIMIT {ROW_LIMIT}) c"

ORACLES["ols_regr"] = f"""
WITH f AS (SELECT count(*) AS n, regr_slope(price, quantity) AS slope,
                  regr_intercept(price, quantity) AS intercept FROM {LI} c)
SELECT n, {R('slope', 9)} AS slope, {R('intercept', 9)} AS intercept FROM f"""
ORACLES["ols_closed_form"] = ORACLES["ols_view"] = ORACLES["ols_regr"]

ORACLES["mse_at"] = f"""
WITH p AS (SELECT regr_slope(price, quantity) AS slope,
                  regr_intercept(price, quantity) AS intercept FROM {LI} c),
m AS (SELECT any_value(p.slope) AS slope, any_value(p.intercept) AS intercept,
        avg((price - (p.slope * quantity + p.intercept)) * (price - (p.slope * quantity + p.intercept))) AS mse,
        avg((price - (0.1 * quantity + 0.1)) * (price - (0.1 * quantity + 0.1))) AS mse_initial
      FROM {LI} c CROSS JOIN p)
SELECT {R('slope', 8)} AS slope, {R('intercept', 8)} AS intercept,
       {R('mse', 8)} AS mse, {R('mse_initial', 8)} AS mse_initial FROM m"""

ORACLES["fit_sample"] = f"""
SELECT l_orderkey, l_linenumber, quantity, price FROM {LI} c
ORDER BY l_orderkey, l_linenumber LIMIT 1001"""

ORACLES["line_points"] = f"""
WITH p AS (SELECT regr_slope(price, quantity) AS slope,
                  regr_intercept(price, quantity) AS intercept FROM {LI} c),
smp AS (SELECT quantity FROM {LI} c ORDER BY l_orderkey, l_linenumber LIMIT 1001),
b AS (SELECT min(quantity) AS x_min, max(quantity) AS x_max,
             CAST(floor((max(quantity) - min(quantity)) / 0.1) AS BIGINT) AS k FROM smp),
g AS (SELECT i, CASE WHEN k = 1 THEN x_min WHEN i = k - 1 THEN x_max
                     ELSE CAST(i AS DOUBLE) * ((x_max - x_min) / CAST(k - 1 AS DOUBLE)) + x_min END AS x
      FROM b, range(0, k) AS r(i) WHERE k >= 1),
o AS (SELECT i, x, slope * x + intercept AS y FROM g CROSS JOIN p)
SELECT i, {R('x', 8)} AS x, {R('y', 8)} AS y FROM o"""


# ---------------------------------------------------------------- parsing


ORACLES["parse_pages"] = f"""
WITH l AS (
  SELECT page_id, '<doc id="' || CAST(page_id AS VARCHAR) || '" url="' || url || '">' || html || '</doc>' AS value
  FROM pages),
p AS (
  SELECT page_id, value, regexp_extract(value, {sql_str(ID_PATTERN)}, 1) AS id,
         regexp_extract(value, {sql_str(BODY_SHORTEST)}, 1) AS text
  FROM l WHERE regexp_matches(value, {sql_str(ID_PATTERN)}) AND regexp_matches(value, {sql_str(BODY_SHORTEST)}))
SELECT page_id, id, CAST(length(text) AS BIGINT) AS body_len, md5(text) AS body_md5,
       CAST(length(regexp_extract(value, {sql_str(BODY_GREEDY)}, 1)) AS BIGINT) AS greedy_len,
       contains(value, {sql_str(CLASS_ONE_MARK)}) AS is_class_one,
       substring(text, 1, 200) AS snippet
FROM p"""

MARKED_LINES = """
  SELECT d.doc_id, '<doc id="' || CASE WHEN lb.toxic = 1 THEN 'AU' ELSE 'XX' END
         || CAST(d.doc_id AS VARCHAR) || '" title="t">' || d.text || '</doc>' AS value
  FROM documents d JOIN labels lb ON d.doc_id = lb.doc_id"""

ORACLES["parse_counts"] = f"""
WITH l AS ({MARKED_LINES}),
c AS (SELECT CASE WHEN doc_id % 7 = 0 THEN left(value, length(value) - 3) ELSE value END AS value FROM l)
SELECT count(*) AS lines, count(*) FILTER (WHERE regexp_matches(value, {sql_str(BODY_GREEDY)})) AS parsed,
       count(*) FILTER (WHERE NOT regexp_matches(value, {sql_str(BODY_GREEDY)})) AS unmatched FROM c"""

ORACLES["parse_marked_docs"] = f"""
WITH l AS ({MARKED_LINES}),
p AS (
  SELECT doc_id, regexp_extract(value, {sql_str(BODY_GREEDY)}, 1) AS text,
         CASE WHEN contains(value, {sql_str(CLASS_ONE_MARK)}) THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS label
  FROM l WHERE regexp_matches(value, {sql_str(BODY_GREEDY)}))
SELECT doc_id, label, CAST(length(text) AS BIGINT) AS body_len, md5(text) AS body_md5 FROM p"""


# ---------------------------------------------------------------- text features



def text_ctes(docs_sql: str, dim: int = DIM, rule: str = "not_all", p: str = "",
              vocab: str | None = None) -> str:
    """CTEs ``{p}d {p}w {p}cnt {p}tf {p}tfidf`` (and, unless an existing
    ``vocab`` CTE is named, ``{p}n {p}dfreq {p}vocab``) over a documents query
    with columns ``doc_id, text``."""
    if rule == "not_all":
        keep = "f.df <> n.n_docs"
    elif rule == "forced":
        words = ", ".join(sql_str(w) for w in FORCED_WORDS)
        keep = f"(f.word IN ({words}) OR f.df <> n.n_docs)"
    elif rule == "max_df":
        keep = "CAST(f.df AS DOUBLE) / CAST(n.n_docs AS DOUBLE) <= 0.8"
    else:
        raise ValueError(rule)
    out = f"""
{p}d AS (SELECT * FROM ({docs_sql}) t WHERE text IS NOT NULL),
{p}w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
               len(string_split(text, ' ')) AS n_tok FROM {p}d),"""
    if vocab is None:
        vocab = f"{p}vocab"
        out += f"""
{p}n AS (SELECT count(*) AS n_docs FROM {p}d),
{p}dfreq AS (SELECT word, count(DISTINCT doc_id) AS df FROM {p}w GROUP BY word),
{p}vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY df DESC, word) - 1 AS INTEGER) AS idx, word, df, n_docs,
         ln(CAST(n_docs + 1 AS DOUBLE) / CAST(df + 1 AS DOUBLE)) AS idf
  FROM (SELECT f.word, f.df, n.n_docs FROM {p}dfreq f, {p}n n WHERE {keep}
        ORDER BY f.df DESC, f.word LIMIT {dim}) t),"""
    out += f"""
{p}cnt AS (SELECT w.doc_id, w.n_tok, v.idx, count(*) AS cnt
           FROM {p}w w JOIN {vocab} v ON w.word = v.word GROUP BY w.doc_id, w.n_tok, v.idx),
{p}tf AS (SELECT c.doc_id, c.idx, v.word, c.cnt / CAST(c.n_tok AS DOUBLE) AS tf
          FROM {p}cnt c JOIN {vocab} v ON c.idx = v.idx),
{p}tfidf AS (SELECT c.doc_id, c.idx, c.cnt / CAST(c.n_tok AS DOUBLE) * v.idf AS x
             FROM {p}cnt c JOIN {vocab} v ON c.idx = v.idx)"""
    return out


DOCS = "SELECT doc_id, text FROM documents"

ORACLES["doc_freq"] = f"WITH {text_ctes(DOCS)} SELECT word, df FROM dfreq"

for _name, _rule in (("vocab_not_all", "not_all"), ("vocab_forced", "forced"),
                     ("vocab_max_df", "max_df")):
    ORACLES[_name] = f"WITH {text_ctes(DOCS, rule=_rule)} SELECT idx, word, df FROM vocab"

    ORACLES[_name.replace("vocab_", "vocab_summary_")] = ORACLES[_name]

ORACLES["term_freq"] = f"""WITH {text_ctes(DOCS)}
SELECT doc_id, idx, word, {R('tf', 9)} AS tf FROM tf"""

ORACLES["tfidf"] = f"""WITH {text_ctes(DOCS)}
SELECT doc_id, idx, {R('x', 9)} AS x FROM tfidf"""

ORACLES["topk_similar_docs"] = f"""WITH {text_ctes(DOCS)},
q AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1),
qw AS (SELECT unnest(string_split(text, ' ')) AS word, len(string_split(text, ' ')) AS n_tok FROM q),
qc AS (SELECT v.idx, count(*) / CAST(any_value(qw.n_tok) AS DOUBLE) * any_value(v.idf) AS qx
       FROM qw JOIN vocab v ON qw.word = v.word GROUP BY v.idx),
s AS (SELECT t.doc_id, sum(t.x * qc.qx) AS score FROM tfidf t JOIN qc ON t.idx = qc.idx GROUP BY t.doc_id),
a AS (SELECT d.doc_id, round(coalesce(s.score, 0.0), 9) AS score, substring(d.text, 1, 200) AS snippet
      FROM d LEFT JOIN s ON d.doc_id = s.doc_id)
SELECT CAST(row_number() OVER (ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score, snippet
FROM a QUALIFY rank <= {TOP_K} ORDER BY rank"""
ORACLES["topk_kept_vectors"] = ORACLES["topk_indexed"] = ORACLES["topk_similar_docs"]

ORACLES["topk_all_texts"] = f"""WITH {text_ctes(DOCS)},
qw AS (SELECT item_id, unnest(string_split(text, ' ')) AS word, len(string_split(text, ' ')) AS n_tok FROM benchmark WHERE text IS NOT NULL),
qc AS (SELECT qw.item_id, v.idx, count(*) / CAST(any_value(qw.n_tok) AS DOUBLE) * any_value(v.idf) AS qx
       FROM qw JOIN vocab v ON qw.word = v.word GROUP BY qw.item_id, v.idx),
s AS (SELECT qc.item_id, t.doc_id, sum(t.x * qc.qx) AS score FROM tfidf t JOIN qc ON t.idx = qc.idx GROUP BY qc.item_id, t.doc_id),
a AS (SELECT b.item_id, d.doc_id, round(coalesce(s.score, 0.0), 9) AS score, substring(d.text, 1, 200) AS snippet
      FROM (SELECT DISTINCT item_id FROM qw) b CROSS JOIN d LEFT JOIN s ON d.doc_id = s.doc_id AND b.item_id = s.item_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score, snippet
FROM a QUALIFY rank <= {TOP_K}"""


# ---------------------------------------------------------------- classes

LABELLED = ("SELECT d.doc_id, d.text, CAST(lb.toxic AS DOUBLE) AS label "
            "FROM documents d JOIN labels lb ON d.doc_id = lb.doc_id WHERE d.text IS NOT NULL")
IS_TEST = "(((doc_id % 10) + 10) % 10) = 0"
TRAIN = f"SELECT * FROM ({LABELLED}) x WHERE NOT {IS_TEST}"
TEST = f"SELECT * FROM ({LABELLED}) x WHERE {IS_TEST}"
_WORDS = ", ".join(sql_str(w) for w in FORCED_WORDS)

ORACLES["class_mean_tf"] = f"""WITH {text_ctes(LABELLED, rule="forced")},
sel AS (SELECT doc_id, label FROM d
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) <= {CLASS_PROFILE_N}),
cls AS (SELECT label, count(*) AS n_docs FROM sel GROUP BY label),
wd AS (SELECT unnest([{_WORDS}]) AS word),
ts AS (SELECT s.label, t.word, sum(t.tf) AS s FROM tf t JOIN sel s ON t.doc_id = s.doc_id
       GROUP BY s.label, t.word),
o AS (SELECT c.label, wd.word, coalesce(ts.s, 0.0) / CAST(c.n_docs AS DOUBLE) AS avg_tf, c.n_docs
      FROM cls c CROSS JOIN wd LEFT JOIN ts ON ts.label = c.label AND ts.word = wd.word)
SELECT label, word, {R('avg_tf', 9)} AS avg_tf, n_docs FROM o"""

ORACLES["label_token_stats"] = f"""
WITH t AS (SELECT label, string_split(text, ' ') AS words FROM ({LABELLED}) x)
SELECT label, count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_tok, CAST(sum(len(list_distinct(words))) AS BIGINT) AS n_words
FROM t GROUP BY label"""

ORACLES["stable_split"] = f"SELECT doc_id, label, {IS_TEST} AS is_test FROM ({LABELLED}) x"

ORACLES["label_counts"] = f"SELECT label, count(*) AS n FROM ({TRAIN}) t GROUP BY label"

ORACLES["class_weights"] = f"""
WITH c AS (SELECT label, count(*) AS n FROM ({TRAIN}) t GROUP BY label),
o AS (SELECT label, n, n / CAST(sum(n) OVER () AS DOUBLE) AS share FROM c)
SELECT label, n, {R('share', 12)} AS share FROM o"""

def _margins(theta0: float = THETA0, feats: str = "tfidf", lab: str = "lab") -> str:
    return (f"SELECT l.doc_id, l.label, coalesce(sum(t.x * {theta0!r}), 0.0) + {theta0!r} AS m "
            f"FROM {lab} l LEFT JOIN {feats} t ON l.doc_id = t.doc_id GROUP BY l.doc_id, l.label")


def _model_ctes(kind: str, dim: int = DIM) -> str:
    out = f"""{text_ctes(TRAIN, dim=dim, rule=KIND_RULE[kind])},
lab AS (SELECT doc_id, label FROM d),
wt AS (SELECT label, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM lab GROUP BY label),
pp AS (SELECT count(*) + 1 AS p FROM vocab),
mg AS ({_margins()})"""
    return out


def _loss_expr(kind: str) -> str:
    if kind == "logistic":
        return "ln(1 + exp(-abs(m))) + greatest(m, 0.0) - label * m"
    h = "greatest(0.0, 1.0 - (2.0 * label - 1.0) * m)"
    return h if kind == "hinge" else f"{h} / share"


def _coef_expr(kind: str) -> str:
    if kind == "logistic":
        return "1.0 / (1.0 + exp(-m)) - label"
    c = "CASE WHEN (2.0 * label - 1.0) * m < 1.0 THEN -(2.0 * label - 1.0) ELSE 0.0 END"
    return c if kind == "hinge" else f"({c}) / share"


for _kind in ("logistic", "hinge", "weighted_hinge"):
    _reg = (f" + pp.p * {THETA0!r} * {THETA0!r} * {LAMBDA / 2.0!r} / count(*)"
            if _kind == "logistic" else "")
    ORACLES[f"{_kind}_loss"] = f"""WITH {_model_ctes(_kind)},
o AS (SELECT count(*) AS n, avg({_loss_expr(_kind)}){_reg} AS loss
      FROM mg JOIN wt USING (label) CROSS JOIN pp GROUP BY pp.p)
SELECT n, {R('loss', 9)} AS loss FROM o"""
    _greg = f" + {LAMBDA * THETA0!r} / nn.n" if _kind == "logistic" else ""
    ORACLES[f"{_kind}_grad"] = f"""WITH {_model_ctes(_kind)},
co AS (SELECT doc_id, {_coef_expr(_kind)} AS c FROM mg JOIN wt USING (label)),
gs AS (SELECT t.idx, sum(co.c * t.x) AS g FROM tfidf t JOIN co ON t.doc_id = co.doc_id GROUP BY t.idx),
nn AS (SELECT count(*) AS n FROM lab),
ai AS (SELECT idx FROM vocab UNION ALL SELECT CAST(p - 1 AS INTEGER) FROM pp),
o AS (SELECT ai.idx,
        (CASE WHEN ai.idx = pp.p - 1 THEN (SELECT sum(c) FROM co) ELSE coalesce(gs.g, 0.0) END)
          / nn.n{_greg} AS grad
      FROM ai LEFT JOIN gs ON ai.idx = gs.idx CROSS JOIN nn CROSS JOIN pp)
SELECT idx, {R('grad', 9, 1e-12)} AS grad FROM o"""


def _confusion_sql(threshold: float = 0.5) -> str:
    cnt = []
    for name, cond in (("tp", "same AND label = 1.0"), ("fn", "NOT same AND label = 1.0"),
                       ("fp", "NOT same AND label = 0.0"), ("tn", "same AND label = 0.0")):
        cnt.append(f"count(*) FILTER (WHERE {cond}) AS {name}")
    sel = ", ".join(cnt)
    return f"""WITH {text_ctes(TRAIN, rule="forced")},
{text_ctes(TEST, p="te_", vocab="vocab")},
lab AS (SELECT doc_id, label FROM d),
te_lab AS (SELECT doc_id, label FROM te_d),
pr AS (
  SELECT 'train' AS split, label, abs(label - CASE WHEN m >= {threshold!r} THEN 1.0 ELSE 0.0 END) < 0.001 AS same
  FROM ({_margins()}) a
  UNION ALL
  SELECT 'test' AS split, label, abs(label - CASE WHEN m >= {threshold!r} THEN 1.0 ELSE 0.0 END) < 0.001 AS same
  FROM ({_margins(feats="te_tfidf", lab="te_lab")}) b),
cf AS (SELECT split, {sel} FROM pr GROUP BY split)"""


ORACLES["predict_confusion"] = _confusion_sql() + "\nSELECT * FROM cf"
ORACLES["accuracy_f1"] = _confusion_sql() + f""",
o AS (SELECT *, CAST(tp + tn AS DOUBLE) / CAST(tp + fn + fp + tn AS DOUBLE) AS accuracy,
             CASE WHEN 2 * tp + fp + fn = 0 THEN NULL
                  ELSE 2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1 FROM cf)
SELECT split, tp, fn, fp, tn, {R('accuracy', 12)} AS accuracy, {R('f1', 12)} AS f1 FROM o"""


# ---------------------------------------------------------------- descent
# Recursive CTEs over the same one-pass statistics (count, means, covariances).

def _simple_trace_sql(variant: str) -> str:
    """e1, e2: the distance from the least-squares line along the loss' axes."""
    line = "best_m + c * e1 - sn * e2 AS m, best_b + sn * e1 + c * e2 AS b"
    if variant == "exact":
        axes = """SELECT *, 2.0 AS v1, 2.0 AS v2, yv AS k1, yv AS k2, 0.1 - cov / (sqrt(xv) * sqrt(yv)) AS e1, CAST(0.1 AS DOUBLE) AS e2 FROM f"""
        line = """(cov / (sqrt(xv) * sqrt(yv)) + e1) * (sqrt(yv) / sqrt(xv)) AS m,
         ym + sqrt(yv) * e2 - (cov / (sqrt(xv) * sqrt(yv)) + e1) * (sqrt(yv) / sqrt(xv)) * xm AS b"""
    else:
        axes = """SELECT *, n * l1 AS v1, n * l2 AS v2, l1 AS k1, l2 AS k2,
    c * (0.1 - best_m) + sn * (0.1 - best_b) AS e1, c * (0.1 - best_b) - sn * (0.1 - best_m) AS e2
  FROM (SELECT *, xv / l1 AS l2, (l1 - 1.0) / sqrt((l1 - 1.0) * (l1 - 1.0) + xm * xm) AS c,
               xm / sqrt((l1 - 1.0) * (l1 - 1.0) + xm * xm) AS sn
        FROM (SELECT *, (xv + xm * xm + 1.0) / 2.0 + sqrt((xv + xm * xm - 1.0) * (xv + xm * xm - 1.0) / 4.0 + xm * xm) AS l1 FROM f) g) h"""
    return f"""WITH RECURSIVE m0 AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(quantity) AS xm, avg(price) AS ym, var_pop(quantity) AS xv,
   var_pop(price) AS yv, covar_pop(quantity, price) AS cov FROM {LI} c),
f AS (SELECT *, cov / xv AS best_m, ym - cov / xv * xm AS best_b, yv - cov / xv * cov AS base FROM m0),
s AS ({axes}),
t AS (
  SELECT 0 AS step, e1, e2, k1 * e1 * e1 + k2 * e2 * e2 AS loss, CAST(0.01 AS DOUBLE) AS lr, CAST(0.01 AS DOUBLE) AS lr_next FROM s
  UNION ALL
  SELECT step, e1, e2, loss, lr, CASE WHEN loss > loss_old THEN lr * 0.5 ELSE lr * 1.05 END
  FROM (SELECT step, e1, e2, k1 * e1 * e1 + k2 * e2 * e2 AS loss, lr, loss_old
        FROM (SELECT t.step + 1 AS step, t.e1 * (1.0 - s.v1 * t.lr_next) AS e1, t.e2 * (1.0 - s.v2 * t.lr_next) AS e2,
                     t.lr_next AS lr, t.loss AS loss_old, s.k1, s.k2
              FROM t CROSS JOIN s WHERE t.step < 100) u) q),
o AS (
  SELECT -1 AS step, base AS loss, CAST(NULL AS DOUBLE) AS learning_rate, best_m AS m, best_b AS b FROM s
  UNION ALL
  SELECT step, base + loss, lr, m, b FROM (SELECT t.step, t.loss, t.lr, s.base, {line}
    FROM t, (SELECT * EXCLUDE (e1, e2) FROM s) s) w),
z AS (SELECT *, lag(loss) OVER (ORDER BY step) AS loss_old FROM o)
SELECT step, {R('loss', 9)} AS loss, {R('loss_old', 9)} AS loss_old, {R('learning_rate', 9)} AS learning_rate,
       {R('m', 9)} AS m, {R('b', 9)} AS b FROM z"""


ORACLES["gd_simple_trace"] = _simple_trace_sql("exact")
ORACLES["gd_simple_observed"] = _simple_trace_sql("observed")


def _dot_sql(a: list[str], b: list[str]) -> str:
    out = f"{a[0]} * {b[0]}"
    for x, y in zip(a[1:], b[1:]):
        out = f"({out} + {x} * {y})"
    return out


def _multi_trace_sql(variant: str) -> str:
    """Standardised units and back for the exact rule, raw ones (prices in
    thousands) for the observed."""
    k = range(len(MULTI_X))
    exact = variant == "exact"
    y = "price" if exact else "(price / 1000.0)"
    stats = [f"avg({y}) AS ym", f"var_pop({y}) AS yv"]
    for a in k:
        stats += [f"avg({MULTI_X[a]}) AS m_{a}", f"covar_pop({MULTI_X[a]}, {y}) AS c_{a}_y"]
        stats += [f"covar_pop({MULTI_X[a]}, {MULTI_X[b]}) AS c_{a}_{b}" for b in k if b > a]
        stats.append(f"var_pop({MULTI_X[a]}) AS c_{a}_{a}")

    def cxx(a, b):
        a, b = min(a, b), max(a, b)
        if not exact:
            return f"s.c_{a}_{b}"
        return "1.0" if a == b else f"(s.c_{a}_{b} / (sqrt(s.c_{a}_{a}) * sqrt(s.c_{b}_{b})))"

    cxy = [f"(s.c_{a}_y / (sqrt(s.c_{a}_{a}) * sqrt(s.yv)))" if exact else f"s.c_{a}_y" for a in k]
    ct = lambda tv: [_dot_sql([cxx(j, i) for i in k], tv) for j in k]
    off = lambda tv, bias: f"(s.ym - ({_dot_sql(tv, [f's.m_{j}' for j in k])}) - {bias})"

    def loss_of(tv: list[str], bias: str) -> str:
        last = f"{bias} * {bias}" if exact else f"{off(tv, bias)} * {off(tv, bias)}"
        first = "1.0" if exact else "s.yv"
        return f"{first} - 2.0 * ({_dot_sql(tv, cxy)}) + ({_dot_sql(tv, ct(tv))}) + {last}"

    tv, uv = [f"t.t{j}" for j in k], [f"u.t{j}" for j in k]
    if exact:
        grads, gbias = [f"-2.0 * ({cxy[j]} - ({ct(tv)[j]}))" for j in k], "2.0 * t.tb"
        w = [f"t{j} * sqrt(s.yv) / sqrt(s.c_{j}_{j})" for j in k]
        const = f"s.ym + sqrt(s.yv) * tb - ({_dot_sql([f'({x})' for x in w], [f's.m_{j}' for j in k])})"
        loss = "loss * s.yv"
    else:
        grads, gbias = [f"-2.0 * t.t{j} * {off(tv, 't.tb')}" for j in k], f"-2.0 * t.tb * {off(tv, 't.tb')}"
        w, const, loss = [f"t{j}" for j in k], "tb", "loss"
    upd = ", ".join(f"t.t{j} - ({grads[j]}) * t.lr_next AS t{j}" for j in k)
    init_t = ", ".join(f"CAST(0.1 AS DOUBLE) AS t{j}" for j in k)
    cols = ", ".join(f"q.t{j}" for j in k)
    ucols = ", ".join(f"u.t{j}" for j in k)
    outw = ", ".join(f"{R(f'w{j}', 9)} AS w_{x}" for j, x in enumerate(MULTI_X))
    return f"""WITH RECURSIVE s AS (SELECT {', '.join(stats)} FROM {LI} c),
t AS (
  SELECT 0 AS step, {init_t}, CAST(0.1 AS DOUBLE) AS tb, {loss_of(['0.1'] * len(k), '0.1')} AS loss,
         CAST(0.001 AS DOUBLE) AS lr, CAST(0.001 AS DOUBLE) AS lr_next, 0 AS hits, false AS stopped FROM s
  UNION ALL
  SELECT q.step, {cols}, q.tb, q.loss, q.lr, q.lr_next, q.hits,
         q.lr_next < 1e-5 OR q.hits >= 10 AS stopped
  FROM (SELECT r.*, CASE WHEN r.loss > r.loss_old THEN r.lr * 0.5 ELSE r.lr * 1.05 END AS lr_next,
               r.hits_old + CASE WHEN r.loss - r.loss_old < 1e-5 THEN 1 ELSE 0 END AS hits
        FROM (SELECT u.step, {ucols}, u.tb, {loss_of(uv, 'u.tb').replace('s.', 'u.')} AS loss,
                     u.lr, u.loss_old, u.hits_old
              FROM (SELECT t.step + 1 AS step, {upd}, t.tb - ({gbias}) * t.lr_next AS tb,
                           t.lr_next AS lr, t.loss AS loss_old, t.hits AS hits_old, s.*
                    FROM t CROSS JOIN s WHERE t.step < 100 AND NOT t.stopped) u) r) q),
o AS (SELECT step, {loss} AS loss, lr, {', '.join(f'{x} AS w{j}' for j, x in enumerate(w))}, {const} AS wc FROM t CROSS JOIN s),
z AS (SELECT *, lag(loss) OVER (ORDER BY step) AS loss_old FROM o)
SELECT step, {R('loss', 9)} AS loss, {R('loss_old', 9)} AS loss_old, {R('lr', 9)} AS learning_rate, {outw},
       {R('wc', 9)} AS w_const FROM z"""


ORACLES["gd_multi_trace"] = _multi_trace_sql("exact")
ORACLES["gd_multi_observed"] = _multi_trace_sql("observed")


# ---------------------------------------------------------------- classifier traces
# Unrolled CTEs: θ_k is a table (idx, w) with the bias at idx p - 1; each step
# joins it with the TF-IDF entries for margins, then gradient and loss.

TIE_DIGITS = 12


def _margin_at(k: int) -> str:
    return f"""mg{k} AS (
  SELECT l.doc_id, l.label, wt.share,
         coalesce(sum(t.x * th.w), 0.0) + (SELECT b.w FROM th{k} b, pp WHERE b.idx = pp.p - 1) AS m
  FROM lab l JOIN wt ON l.label = wt.label
       LEFT JOIN tfidf t ON l.doc_id = t.doc_id LEFT JOIN th{k} th ON t.idx = th.idx
  GROUP BY l.doc_id, l.label, wt.share)"""


def _coef_observed(kind: str) -> str:
    if kind == "logistic":
        return "-label"                      # plus h on every slot (dense term)
    c = "CASE WHEN m < 1.0 THEN -(2.0 * label - 1.0) ELSE 0.0 END"
    return c if kind == "hinge" else f"({c}) / share"


def _grad_at(k: int, kind: str, variant: str = "exact") -> str:
    """Gradient table gf{k}(idx, w, g): mean gradient (exact), or the summed
    observed one (logistic observed: h on every slot, then averaged)."""
    coef = _coef_expr(kind) if variant == "exact" else _coef_observed(kind)
    dense = ""
    if variant == "observed" and kind == "logistic":
        dense = f" + (SELECT sum(1.0 / (1.0 + exp(-m))) FROM mg{k})"
    scale = "/ CAST(nn.n AS DOUBLE)" if (variant == "exact" or kind == "logistic") else ""
    return f"""co{k} AS (SELECT doc_id, {coef} AS c FROM mg{k}),
gs{k} AS (SELECT t.idx, sum(co.c * t.x) AS g FROM tfidf t JOIN co{k} co ON t.doc_id = co.doc_id
          GROUP BY t.idx),
gf{k} AS (SELECT th.idx, th.w,
            (CASE WHEN th.idx = pp.p - 1 THEN (SELECT sum(c) FROM co{k}) ELSE coalesce(gs.g, 0.0) END{dense})
              {scale} AS g
          FROM th{k} th LEFT JOIN gs{k} gs ON th.idx = gs.idx CROSS JOIN pp CROSS JOIN nn)"""


def _logistic_trace_sql(steps: int = STEPS, evaluate: bool = False,
                        variant: str = "exact", dim: int = DIM,
                        min_rate: float = 0.01) -> str:
    """sp{k}: the loop has stopped after step k (rate below ``min_rate``);
    θ is frozen from then on and later trace rows are dropped."""
    parts = [_model_ctes("logistic", dim).split(",\nmg AS")[0],
             "nn AS (SELECT count(*) AS n FROM lab)",
             "th0 AS (SELECT idx, CAST(0.1 AS DOUBLE) AS w FROM vocab "
             "UNION ALL SELECT CAST(p - 1 AS INTEGER), CAST(0.1 AS DOUBLE) FROM pp)",
             "r0 AS (SELECT CAST(0.1 AS DOUBLE) AS lr)",
             "sp0 AS (SELECT false AS stop)"]
    for k in range(steps + 1):
        parts.append(_margin_at(k))
        parts.append(f"""ls{k} AS (
  SELECT avg({_loss_expr('logistic')}) + (SELECT sum(w * w) FROM th{k}) * {LAMBDA!r} / 2.0
           / CAST((SELECT n FROM nn) AS DOUBLE) AS loss FROM mg{k})""")
        if k > 0:
            parts.append(f"""r{k} AS (SELECT CASE WHEN a.loss > b.loss THEN r.lr * 0.75 ELSE r.lr * 1.1 END AS lr
  FROM ls{k} a, ls{k - 1} b, r{k - 1} r)""")
            parts.append(f"sp{k} AS (SELECT sp.stop OR r.lr < {min_rate!r} AS stop FROM sp{k - 1} sp, r{k} r)")
        if k < steps:
            parts.append(_grad_at(k, "logistic", variant))
            parts.append(f"""th{k + 1} AS (SELECT gf.idx,
    CASE WHEN sp.stop THEN gf.w
         ELSE gf.w - r.lr * (gf.g + {LAMBDA!r} / CAST(nn.n AS DOUBLE) * gf.w) END AS w
  FROM gf{k} gf CROSS JOIN r{k} r CROSS JOIN nn CROSS JOIN sp{k} sp)""")
    if evaluate:
        return _eval_tail(parts, "logistic", f"th{steps}", LOGISTIC_THRESHOLD)
    rows = ["SELECT 0 AS step, ls0.loss, r0.lr AS learning_rate FROM ls0, r0"]
    rows += [f"SELECT {k} AS step, ls{k}.loss, r{k - 1}.lr FROM ls{k}, r{k - 1}, sp{k - 1} "
             f"WHERE NOT sp{k - 1}.stop" for k in range(1, steps + 1)]
    body = ",\n".join(parts)
    return (f"WITH {body},\no AS ({' UNION ALL '.join(rows)})\n"
            f"SELECT step, {R('loss', 9)} AS loss, {R('learning_rate', 9)} AS learning_rate FROM o")


def _hinge_trace_sql(kind: str, steps: int = STEPS, dim: int = DIM,
                     evaluate: bool = False, variant: str = "exact",
                     min_rate: float = 1e-6) -> str:
    """Exact variant: mean gradient, s = 0.9 s + 0.1 g·g/dim, step rate/(sqrt(s)+1e-8);
    reject (roll back) when the loss rose by more than 5 %. hs{k}: stopped at
    step k (rate below ``min_rate``): θ frozen, later rows dropped."""
    parts = [_model_ctes(kind, dim).split(",\nmg AS")[0],
             "hs0 AS (SELECT false AS stop)",
             "nn AS (SELECT count(*) AS n FROM lab)",
             "th1 AS (SELECT idx, CAST(0.1 AS DOUBLE) AS w FROM vocab "
             "UNION ALL SELECT CAST(p - 1 AS INTEGER), CAST(0.1 AS DOUBLE) FROM pp)",
             "old1 AS (SELECT * FROM th1)",
             "st0 AS (SELECT CAST(0.01 AS DOUBLE) AS lr, CAST(NULL AS DOUBLE) AS loss, "
             "CAST(0.0 AS DOUBLE) AS s, CAST(0.0 AS DOUBLE) AS p0)"]
    exact = variant == "exact"
    for k in range(1, steps + 1):
        parts.append(_margin_at(k))
        parts.append(f"ls{k} AS (SELECT avg({_loss_expr(kind)}) AS loss FROM mg{k})")
        parts.append(_grad_at(k, kind, variant))
        gg = f"((SELECT sum(g * g) FROM gf{k}) / {float(dim)!r})"
        s_new = f"0.9 * st.s + 0.1 * {gg}" if exact else "st.s"
        # losses compared at 12 significant digits (ties stay ties)
        cur_r, old_r = R("l.loss", TIE_DIGITS), R("st.loss", TIE_DIGITS)
        parts.append(f"""dc{k} AS (
  SELECT lr_used, cur, loss_old, p0_old, gg, s,
         coalesce(old_r - cur_r < 0, false) AS rose,
         coalesce(old_r - cur_r < 0 AND cur_r / old_r > 1.05, false) AS reject,
         coalesce(0 <= (old_r - cur_r) / old_r AND (old_r - cur_r) / old_r < 0.01, false) AS small
  FROM (SELECT st.lr AS lr_used, l.loss AS cur, st.loss AS loss_old, st.p0 AS p0_old, {gg} AS gg,
               {s_new} AS s, {cur_r} AS cur_r, {old_r} AS old_r
        FROM st{k - 1} st, ls{k} l) q)""")
        p0_new = ("p0_old" if exact else
                  "CASE WHEN reject OR rose OR small THEN p0_old "
                  "ELSE p0_old + (0.9 * p0_old + 0.1 * sqrt(gg) + 1e-8) END")
        last = "lr_used" if exact else "lr_used / p0"
        parts.append(f"""st{k} AS (
  SELECT CASE WHEN reject THEN lr_used * 0.5 WHEN rose THEN lr_used * 0.75
              WHEN small THEN lr_used * 1.1 ELSE {last} END AS lr,
         CASE WHEN reject THEN loss_old ELSE cur END AS loss, s, p0, reject
  FROM (SELECT *, {p0_new} AS p0 FROM dc{k}) q)""")
        step = "st.lr / (sqrt(st.s) + 1e-8)" if exact else "st.lr"
        parts.append(f"hs{k} AS (SELECT h.stop OR st.lr < {min_rate!r} AS stop FROM hs{k - 1} h, st{k} st)")
        if k <= steps:
            parts.append(f"""th{k + 1} AS (
  SELECT gf.idx, CASE WHEN h.stop THEN gf.w WHEN st.reject THEN o.w
                      ELSE gf.w - {step} * gf.g END AS w
  FROM gf{k} gf JOIN old{k} o ON gf.idx = o.idx CROSS JOIN st{k} st CROSS JOIN hs{k} h)""")
            parts.append(f"""old{k + 1} AS (
  SELECT o.idx, CASE WHEN st.reject THEN o.w ELSE th.w END AS w
  FROM old{k} o JOIN th{k} th ON o.idx = th.idx CROSS JOIN st{k} st)""")
    if evaluate:
        return _eval_tail(parts, kind, f"th{steps + 1}", HINGE_THRESHOLD)
    rows = [f"SELECT {k} AS step, ls{k}.loss, st{k - 1}.lr AS learning_rate "
            f"FROM ls{k}, st{k - 1}, hs{k - 1} WHERE NOT hs{k - 1}.stop" for k in range(1, steps + 1)]
    body = ",\n".join(parts)
    return (f"WITH {body},\no AS ({' UNION ALL '.join(rows)})\n"
            f"SELECT step, {R('loss', 9)} AS loss, {R('learning_rate', 9)} AS learning_rate FROM o")


def _eval_tail(parts: list[str], kind: str, theta: str, threshold: float) -> str:
    """Confusion, accuracy and F1 of the final θ table on train and test."""
    test_ctes = text_ctes(TEST, p="te_", vocab="vocab").lstrip()
    parts = parts + [test_ctes, "te_lab AS (SELECT doc_id, label FROM te_d)"]
    for name, lab, feats in (("tr", "lab", "tfidf"), ("te", "te_lab", "te_tfidf")):
        parts.append(f"""ev_{name} AS (
  SELECT l.label, coalesce(sum(t.x * th.w), 0.0) + (SELECT b.w FROM {theta} b, pp WHERE b.idx = pp.p - 1) AS m
  FROM {lab} l LEFT JOIN {feats} t ON l.doc_id = t.doc_id LEFT JOIN {theta} th ON t.idx = th.idx
  GROUP BY l.doc_id, l.label)""")
    cnt = []
    for nm, cond in (("tp", "same AND label = 1.0"), ("fn", "NOT same AND label = 1.0"),
                     ("fp", "NOT same AND label = 0.0"), ("tn", "same AND label = 0.0")):
        cnt.append(f"count(*) FILTER (WHERE {cond}) AS {nm}")
    same = f"abs(label - CASE WHEN m >= {threshold!r} THEN 1.0 ELSE 0.0 END) < 0.001 AS same"
    parts.append(f"""pr AS (SELECT 'train' AS split, label, {same} FROM ev_tr
  UNION ALL SELECT 'test' AS split, label, {same} FROM ev_te)""")
    parts.append(f"cf AS (SELECT split, {', '.join(cnt)} FROM pr GROUP BY split)")
    body = ",\n".join(parts)
    return f"""WITH {body},
o AS (SELECT *, CAST(tp + tn AS DOUBLE) / CAST(tp + fn + fp + tn AS DOUBLE) AS accuracy,
             CASE WHEN 2 * tp + fp + fn = 0 THEN NULL
                  ELSE 2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1 FROM cf)
SELECT split, tp, fn, fp, tn, {R('accuracy', 12)} AS accuracy, {R('f1', 12)} AS f1 FROM o"""


for _variant, _end in (("exact", ""), ("observed", "_observed")):
    ORACLES[f"logistic_trace{_end}"] = _logistic_trace_sql(variant=_variant)
    ORACLES[f"svm_trace{_end}"] = _hinge_trace_sql("hinge", variant=_variant)
    ORACLES[f"weighted_svm_trace{_end}"] = _hinge_trace_sql("weighted_hinge", variant=_variant)

ORACLES["logistic_trace_resumed"] = ORACLES["logistic_trace"]
ORACLES["svm_trace_resumed"] = ORACLES["svm_trace_observed"]
ORACLES["weighted_svm_trace_resumed"] = ORACLES["weighted_svm_trace"]

ORACLES["logistic_eval"] = _logistic_trace_sql(evaluate=True)
ORACLES["svm_eval"] = _hinge_trace_sql("hinge", evaluate=True)
ORACLES["weighted_svm_eval"] = _hinge_trace_sql("weighted_hinge", evaluate=True)


ORACLES["logistic_eval_observed"] = _logistic_trace_sql(evaluate=True, variant="observed")
ORACLES["svm_eval_observed"] = _hinge_trace_sql("hinge", evaluate=True, variant="observed")
ORACLES["weighted_svm_eval_observed"] = _hinge_trace_sql("weighted_hinge", evaluate=True, variant="observed")

for _name in ("logistic_trace", "logistic_eval", "svm_trace", "svm_eval", "weighted_svm_eval"):
    ORACLES[f"{_name}_full"] = ORACLES[_name]


# ---------------------------------------------------------------- library
# What is determined of a library fit; that its loss is below θ = 0's is a fact.

def _svc_sql(rows: str) -> str:
    return f"""
SELECT CASE WHEN {IS_TEST} THEN 'test' ELSE 'train' END AS split, count(*) AS n,
       count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives,
       CASE WHEN {IS_TEST} THEN NULL ELSE true END AS below_start
FROM ({rows}) r GROUP BY {IS_TEST}"""


ORACLES["linear_svc"] = _svc_sql("SELECT vec_id AS doc_id, ((label % 2) + 2) % 2 AS label FROM embeddings")
ORACLES["linear_svc_tfidf"] = _svc_sql(LABELLED)
