"""SQL over the same tables, written without any model library.

Naive Bayes is spelled out as sums and logarithms. The other models are asked
questions whose best answer is known: a rule of the features, or the commonest
label among rows with equal features.
"""

from __future__ import annotations

from checks.fixtures import CELLS, HEADER
from tallyframe.catalog import ALL_KINDS, BAYES, FEATURES_COLUMN, LABEL_COLUMN, TREE

# Text lines.

_PLAIN = (
    "concat_ws(';', CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), "
    "CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR), "
    "CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR))"
)
_EMBEDDED = "l_linenumber = 1 AND l_returnflag = 'R'"
_VALUE = (
    f"CASE WHEN l_linenumber = 7 THEN {_PLAIN} || ';;' "
    f"WHEN {_EMBEDDED} THEN '{HEADER};' || {_PLAIN} ELSE {_PLAIN} END"
)
_ALL_LINES = (
    f"SELECT '{HEADER}' AS value UNION ALL SELECT '{HEADER}' AS value "
    f"UNION ALL SELECT {_VALUE} AS value FROM lineitem"
)
_KEPT = f"WITH kept AS (SELECT value FROM ({_ALL_LINES}) WHERE NOT contains(value, '{HEADER}'))"
_FIELD = "string_split(regexp_replace(value, ';+$', ''), ';')"
_FIELDS = ", ".join(f"CAST({_FIELD}[{i + 1}] AS DOUBLE) AS f{i}" for i in range(4))
_LAST = f"CAST({_FIELD}[-1] AS DOUBLE) AS label"

_NUMBER = "CAST(l_quantity AS VARCHAR)"
_ODD = f"""SELECT l_linenumber AS kind, CAST(l_linenumber AS DOUBLE) AS label,
  CASE l_linenumber WHEN 1 THEN 'x;' || {_NUMBER} || ';1.0' WHEN 2 THEN 'nan;' || {_NUMBER} || ';2.0'
    WHEN 3 THEN 'NaN;' || {_NUMBER} || ';3.0' WHEN 4 THEN {_NUMBER} || ';4.0'
    WHEN 5 THEN '0.0;0.0;' || {_NUMBER} || ';5.0' WHEN 6 THEN '-Infinity;' || {_NUMBER} || ';6.0'
    ELSE '0.5;' || {_NUMBER} || ';' || CAST(CAST(l_linenumber AS DOUBLE) AS VARCHAR) END AS value
  FROM lineitem"""

# Labelled examples.

_GRADED = """ex AS (
  SELECT row_number() OVER () AS id, l_orderkey, l_linenumber,
    CAST(CASE WHEN l_quantity > 25
      THEN CASE WHEN l_discount > 0.055 THEN 8 ELSE 6 END
      ELSE CASE WHEN l_tax > 0.035 THEN 5 ELSE 3 END END AS DOUBLE) AS label,
    floor(l_quantity / 2) AS f0, l_extendedprice / 1000 AS f1, l_discount * 100 AS f2, l_tax * 100 AS f3
  FROM lineitem)"""

_CELL_NUMBER = "CASE " + " ".join(
    f"WHEN l_returnflag = '{flag}' AND l_linestatus = '{status}' THEN {i}"
    for i, (flag, status) in enumerate(CELLS)
) + " END"
_CELL_FEATURES = ", ".join(
    f"CAST(CASE WHEN cell = {i} THEN 1 ELSE 0 END AS DOUBLE) AS f{i}" for i in range(len(CELLS))
)
_CELLS = f"""ex AS (
  SELECT id, l_orderkey, l_linenumber, cell, {_CELL_FEATURES},
    CAST(CASE WHEN l_quantity <= 30 THEN 3 + cell
      ELSE 3 + (l_linenumber - 1) % 6 END AS DOUBLE) AS label
  FROM (SELECT row_number() OVER () AS id, *, {_CELL_NUMBER} AS cell FROM lineitem))"""


def _bayes(width: int, asked: str = "ex") -> str:
    """Tables ``par`` (log prior and log likelihoods of ``ex``) and ``nb`` (id, bayes) of ``asked``."""
    sums = ", ".join(f"sum(f{j}) AS s{j}" for j in range(width))
    total = " + ".join(f"s{j}" for j in range(width))
    theta = ", ".join(
        f"ln(s{j} + 1) - ln({total} + {width}) AS theta{j}" for j in range(width)
    )
    log_score = " + ".join(["pi", *[f"f{j} * theta{j}" for j in range(width)]])
    return f"""st AS (SELECT label, count(*) AS n, {sums} FROM ex GROUP BY label),
par AS (
  SELECT label, ln(n + 1) - ln(sum(n) OVER () + count(*) OVER ()) AS pi, {theta} FROM st),
nb AS (
  SELECT id, bayes FROM (
    SELECT {asked}.id, par.label AS bayes,
      row_number() OVER (PARTITION BY {asked}.id ORDER BY {log_score} DESC, par.label) AS rank
    FROM {asked} JOIN par ON TRUE) WHERE rank = 1)"""


_BAYES_GRADED = (
    f"WITH {_GRADED}, {_bayes(4)}, scored AS (SELECT ex.*, bayes AS prediction "
    "FROM ex JOIN nb ON ex.id = nb.id)"
)
_KEYED = "l_orderkey, l_linenumber, label, prediction"

_CELLS_SCORED = f"""WITH {_CELLS}, {_bayes(len(CELLS))},
best AS (
  SELECT cell, label AS best FROM (
    SELECT cell, label, row_number() OVER (
      PARTITION BY cell ORDER BY count(*) DESC, label) AS rank
    FROM ex GROUP BY cell, label) WHERE rank = 1),
scored AS (
  SELECT ex.*, best AS logistic, best AS tree, bayes, best AS forest,
    '[' || concat_ws(',', {", ".join(f"CAST(f{i} AS VARCHAR)" for i in range(len(CELLS)))})
      || ']' AS features
  FROM ex JOIN nb ON ex.id = nb.id JOIN best ON ex.cell = best.cell)"""

# Training and validation rows apart: ``ex`` is learnt from, ``val`` is asked for.
_SPLIT_WIDTH = len(CELLS)
_TENFOLD = _CELL_FEATURES.replace("THEN 1", "THEN 10")
_SPLIT_ITEM = f"""item AS (
  SELECT id, l_orderkey, l_linenumber, cell, {_TENFOLD}, l_orderkey % 10 < 8 AS learnt,
    CAST(CASE WHEN l_quantity <= CASE WHEN l_orderkey % 10 < 8 THEN 10 ELSE 25 END THEN 3 + cell
      WHEN l_quantity <= 40 THEN CASE WHEN cell < 3 THEN 3 ELSE 8 END
      ELSE 3 + (l_linenumber - 1) % 6 END AS DOUBLE) AS label
  FROM (SELECT row_number() OVER () AS id, *, {_CELL_NUMBER} AS cell FROM lineitem))"""
_SPLIT_MODELS = f"""{_bayes(_SPLIT_WIDTH, "val")},
best AS (
  SELECT cell, label AS best FROM (
    SELECT cell, label, row_number() OVER (
      PARTITION BY cell ORDER BY count(*) DESC, label) AS rank
    FROM ex GROUP BY cell, label) WHERE rank = 1),
scored AS (
  SELECT val.*, best AS logistic, best AS tree, bayes, best AS forest,
    '[' || concat_ws(',', {", ".join(f"CAST(f{i} AS VARCHAR)" for i in range(_SPLIT_WIDTH))})
      || ']' AS features
  FROM val JOIN nb ON val.id = nb.id JOIN best ON val.cell = best.cell)"""


def _split(among: str) -> str:
    """``scored``: the validation rows of ``item`` that are ``among``, by models of the training rows."""
    return (
        f"WITH {_SPLIT_ITEM}, ex AS (SELECT * FROM item WHERE learnt AND {among}), "
        f"val AS (SELECT * FROM item WHERE NOT learnt AND {among}), {_SPLIT_MODELS}"
    )


_SPLIT_SCORED = _split("TRUE")
# Lines with these numbers are no examples where they are broken.
_IMPERFECT = "l_linenumber IN (5, 6, 7)"
_SPLIT_LINE = (
    "concat_ws(';', "
    + ", ".join(f"CAST(f{i} AS VARCHAR)" for i in range(_SPLIT_WIDTH))
    + ", CAST(label AS VARCHAR))"
)
_BROKEN = f"""SELECT CASE WHEN learnt THEN 'training' ELSE 'validation' END AS source,
  CASE l_linenumber WHEN 5 THEN 'x;' || {_SPLIT_LINE}
    WHEN 6 THEN substr({_SPLIT_LINE}, instr({_SPLIT_LINE}, ';') + 1)
    ELSE 'ten;' || substr({_SPLIT_LINE}, instr({_SPLIT_LINE}, ';') + 1) END AS value
FROM item WHERE {_IMPERFECT}"""

_REPORT_START = (
    f'features AS "{FEATURES_COLUMN}", CAST(label AS VARCHAR) AS "{LABEL_COLUMN}"'
)
_REPORT_ALL = ", ".join(
    f'CAST({kind.key} AS VARCHAR) AS "{kind.prediction_column}"' for kind in ALL_KINDS
)
_NOISY_SUMMARY = _CELLS_SCORED + ", summary AS (" + " UNION ALL ".join(
    f"SELECT '{kind.title}' AS model, avg(CAST({kind.key} = label AS DOUBLE)) AS accuracy "
    "FROM scored"
    for kind in ALL_KINDS
) + ")"


_SPLIT_SUMMARY = _SPLIT_SCORED + ", summary AS (" + " UNION ALL ".join(
    f"SELECT '{kind.title}' AS model, avg(CAST({kind.key} = label AS DOUBLE)) AS accuracy "
    "FROM scored"
    for kind in ALL_KINDS
) + ")"


def _split_report(kind, column: str) -> str:
    return (
        f'{_SPLIT_SCORED} SELECT {_REPORT_START}, CAST({kind.key} AS VARCHAR) AS "{column}" '
        "FROM scored"
    )


def _noisy(kind) -> str:
    return (
        f"{_CELLS_SCORED} SELECT l_orderkey, l_linenumber, label, {kind.key} AS prediction "
        "FROM scored"
    )


def _planted(label: str) -> str:
    return f"SELECT l_orderkey, l_linenumber, {label} AS label, {label} AS prediction FROM lineitem"


def _report(kind, column: str) -> str:
    return (
        f'{_CELLS_SCORED} SELECT {_REPORT_START}, CAST({kind.key} AS VARCHAR) AS "{column}" '
        "FROM scored"
    )


# Eleven features. A gini tree of five levels is grown level by level: all ways to part
# a node's rows by one feature are scored, and the best one that gains is taken.
_RULE = """CASE WHEN quantity >= 3 AND f1 >= 5 THEN 3 + l_partkey % 5 % 2
    WHEN quantity >= 3 THEN CASE WHEN f2 >= 4 THEN 5 ELSE 6 END
    WHEN f6 % 3 = f4 THEN 7 WHEN f1 + f2 >= 9 THEN 8 ELSE 5 END"""
_ELEVEN = f"""item AS (
  SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    floor((l_quantity - 1) / 10) AS quantity, floor((l_quantity - 1) / 10) AS f0,
    round(l_discount * 100) AS f1, round(l_tax * 100) AS f2, l_linenumber - 1 AS f3,
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS f4,
    CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS f5, month(l_shipdate) - 1 AS f6,
    l_orderkey % 4 AS f7, l_partkey % 5 AS f8, l_suppkey % 3 AS f9, (l_orderkey + l_partkey) % 3 AS f10
  FROM lineitem),
ex AS (
  SELECT *, CAST(CASE WHEN (l_orderkey + 2 * l_partkey + 3 * l_suppkey + l_linenumber) % 6 = 0
    THEN 3 + (l_orderkey + l_linenumber) % 6 ELSE {_RULE} END AS DOUBLE) AS label
  FROM item)"""


def _grown(width: int, levels: int) -> str:
    """Tables from ``ex`` to ``tree`` (id, tree): the prediction of a gini tree for each row."""
    values = ", ".join(f"CAST(f{j} AS DOUBLE)" for j in range(width))
    parts = [
        f"long AS (SELECT id, label, unnest(range({width})) AS j, unnest([{values}]) AS v FROM ex)",
        "at0 AS (SELECT id, label, CAST(1 AS BIGINT) AS node FROM ex)",
    ]
    for k in range(levels):
        parts.append(f"""
held{k} AS (
  SELECT node, j, v, label, count(*) AS n FROM at{k} JOIN long USING (id, label) GROUP BY ALL),
all{k} AS (SELECT node, label, count(*) AS n FROM at{k} GROUP BY ALL),
whole{k} AS (SELECT node, sum(n) AS n, sum(n * n) / sum(n) AS pure FROM all{k} GROUP BY node),
below{k} AS (
  SELECT c.node, c.j, c.v, h.label, sum(h.n) AS n
  FROM (SELECT DISTINCT node, j, v FROM held{k}) c
  JOIN held{k} h ON h.node = c.node AND h.j = c.j AND h.v <= c.v GROUP BY ALL),
cut{k} AS (
  SELECT b.node, b.j, b.v, sum(b.n) AS low, max(w.n) - sum(b.n) AS high,
    sum(b.n * b.n) AS low2, sum((a.n - b.n) * (a.n - b.n)) - sum(a.n * a.n) AS more
  FROM below{k} b JOIN all{k} a USING (node, label) JOIN whole{k} w USING (node) GROUP BY ALL),
gain{k} AS (
  SELECT c.*, low2 / low + (more + w.pure * w.n) / high - w.pure AS gain
  FROM cut{k} c JOIN whole{k} w USING (node) WHERE high > 0),
split{k} AS (
  SELECT node, j, v FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, j, v) AS rank
    FROM gain{k} WHERE gain > 1e-9 * low) WHERE rank = 1),
at{k + 1} AS (
  SELECT a.id, a.label, CASE WHEN s.node IS NULL THEN a.node
    ELSE 2 * a.node + CASE WHEN l.v <= s.v THEN 0 ELSE 1 END END AS node
  FROM at{k} a LEFT JOIN split{k} s USING (node) LEFT JOIN long l ON l.id = a.id AND l.j = s.j)""")
    parts.append(f"""
leaf AS (
  SELECT node, label AS tree FROM (
    SELECT node, label, row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, label) AS rank
    FROM at{levels} GROUP BY node, label) WHERE rank = 1),
tree AS (SELECT id, tree FROM at{levels} JOIN leaf USING (node))""")
    return ", ".join(parts)


_ELEVEN_SCORED = f"""WITH {_ELEVEN}, {_bayes(11)}, {_grown(11, 5)},
scored AS (SELECT ex.*, tree, bayes FROM ex JOIN nb ON ex.id = nb.id JOIN tree ON ex.id = tree.id)"""

# Two classes by a plane through the origin: what is above it, and what naive Bayes makes of it.
_HALVES = """ex AS (
  SELECT row_number() OVER () AS id, CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS DOUBLE) AS label,
    floor(l_quantity / 2) AS f0, 25 - floor(l_quantity / 2) AS f1 FROM lineitem)"""
_HALVES_SUMMARY = f"WITH {_HALVES}, {_bayes(2)} " + " UNION ALL ".join(
    f"SELECT '{kind.title}' AS model, avg(CAST({answer} = label AS DOUBLE)) AS accuracy "
    "FROM ex JOIN nb ON ex.id = nb.id"
    for kind in ALL_KINDS
    for answer in ["bayes" if kind == BAYES else "CAST(f0 > f1 AS DOUBLE)"]
)

_HALF = "CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS DOUBLE)"
_GRADE = f"WITH {_GRADED} SELECT l_orderkey, l_linenumber, label, label AS prediction FROM ex"

_VOTES = (
    "l_orderkey % 10",
    "l_partkey % 10",
    "l_suppkey % 10",
    "l_linenumber % 10",
    "(l_orderkey + l_partkey) % 10",
    "(l_orderkey + l_suppkey) % 10",
    "(l_partkey + l_suppkey) % 10",
    "l_orderkey % 3",
    "l_partkey % 3",
)
_HARD_VOTE = f"""WITH item AS (SELECT row_number() OVER () AS id, * FROM lineitem),
vote AS (
  SELECT id, l_orderkey, l_linenumber, unnest([{", ".join(_VOTES)}]) AS v FROM item),
ranked AS (
  SELECT l_orderkey, l_linenumber, v, row_number() OVER (
    PARTITION BY id ORDER BY count(*) DESC, v) AS rank
  FROM vote GROUP BY id, l_orderkey, l_linenumber, v)
SELECT l_orderkey, l_linenumber, CAST(v AS DOUBLE) AS winner FROM ranked WHERE rank = 1"""

ORACLES: dict[str, str] = {
    "scan_lines": _ALL_LINES,
    "header_line": (
        f"SELECT '{HEADER}' AS header, count(*) AS lines_with_header "
        f"FROM ({_ALL_LINES}) WHERE contains(value, '{HEADER}')"
    ),
    "strip_header": f"{_KEPT} SELECT value FROM kept",
    "split_fields": (
        f"{_KEPT} SELECT value, CAST(len({_FIELD}) AS BIGINT) AS n_fields, "
        f"array_to_string({_FIELD}, '|') AS fields FROM kept"
    ),
    "parse_numeric": f"{_KEPT} SELECT {_FIELDS}, {_LAST} FROM kept",
    "parse_lenient": f"{_KEPT} SELECT {_FIELDS}, {_LAST} FROM kept",
    "rejected_lines": f"SELECT value FROM ({_ALL_LINES}) WHERE contains(value, '{HEADER}')",
    "rejected_odd_lines": f"SELECT value FROM ({_ODD}) WHERE kind IN (1, 2, 4, 5)",
    "parse_odd_lines": (
        f"SELECT '[' || replace(regexp_replace(value, ';[^;]*$', ''), ';', ',') || ']' AS features, "
        f"label FROM ({_ODD}) WHERE kind NOT IN (1, 2, 4, 5)"
    ),
    "label_last_field": f"{_KEPT} SELECT {_LAST} FROM kept",
    "feature_vector": f"{_KEPT} SELECT {_FIELDS} FROM kept",
    "labelled_examples": (
        f"WITH {_CELLS} SELECT label, {', '.join(f'f{i}' for i in range(len(CELLS)))} FROM ex"
    ),
    "vector_text": (
        f"{_KEPT} SELECT '[' || array_to_string({_FIELD}[1:4], ',') || ']' AS features, "
        f"{_FIELD}[5] AS label FROM kept"
    ),
    "bayes_train_params": (
        f"WITH {_GRADED}, {_bayes(4)} SELECT "
        "row_number() OVER (ORDER BY label) - 1 AS class_index, round(pi, 6) AS pi, "
        + ", ".join(f"round(theta{j}, 6) AS theta{j}" for j in range(4))
        + " FROM par"
    ),
    "bayes_predict": f"{_BAYES_GRADED} SELECT {_KEYED} FROM scored",
    "tree_predict": _GRADE,
    "forest_vote_predict": _GRADE,
    "logistic_predict": _planted(_HALF),
    **{f"{kind.key}_predict_noisy": _noisy(kind) for kind in ALL_KINDS},
    "hard_vote": _HARD_VOTE,
    **{
        f"prediction_pairs_{kind.key}": (
            f"{_CELLS_SCORED} SELECT {kind.key} AS prediction, label FROM scored"
        )
        for kind in ALL_KINDS
    },
    "models_side_by_side": (
        f"{_SPLIT_SCORED} SELECT l_orderkey, l_linenumber, label, "
        + ", ".join(f"{kind.key} AS {kind.score_column}" for kind in ALL_KINDS)
        + " FROM scored"
    ),
    "correct_rows": f"{_BAYES_GRADED} SELECT {_KEYED} FROM scored WHERE prediction = label",
    "wrong_rows": f"{_BAYES_GRADED} SELECT {_KEYED} FROM scored WHERE prediction <> label",
    "accuracy": (
        f"{_BAYES_GRADED} SELECT avg(CAST(prediction = label AS DOUBLE)) AS accuracy FROM scored"
    ),
    "error_rate": (
        f"{_BAYES_GRADED} SELECT avg(CAST(prediction <> label AS DOUBLE)) AS error_rate "
        "FROM scored"
    ),
    "accuracy_metrics": (
        f"{_BAYES_GRADED} SELECT avg(CAST(prediction = label AS DOUBLE)) AS accuracy FROM scored"
    ),
    "accuracy_summary": _HALVES_SUMMARY,
    "accuracy_summary_noisy": f"{_NOISY_SUMMARY} SELECT model, accuracy FROM summary",
    "accuracy_lines": (
        f"{_SPLIT_SUMMARY} SELECT 'Accuracy = ' || CAST(accuracy AS VARCHAR) || ' (' || model "
        "|| ' on validation)' AS line FROM summary"
    ),
    "empty_validation_lines": " UNION ALL ".join(
        f"SELECT 'Accuracy = NaN ({kind.title})' AS line, n AS trained_on FROM "
        "(SELECT count(*) AS n FROM lineitem WHERE l_orderkey % 10 < 8)"
        for kind in (TREE, BAYES)
    ),
    **{f"training_report_{k.key}": _report(k, k.training_column) for k in ALL_KINDS},
    **{f"prediction_report_{k.key}": _report(k, k.prediction_column) for k in ALL_KINDS},
    "plain_report": (
        "SELECT '[' || CAST(floor(l_quantity / 2) AS VARCHAR) || ',' "
        "|| CAST(25 - floor(l_quantity / 2) AS VARCHAR) "
        f"|| ']' AS features, CAST({_HALF} AS VARCHAR) AS label, "
        f"CAST({_HALF} AS VARCHAR) AS prediction FROM lineitem"
    ),
    "comparison_report": f"{_SPLIT_SCORED} SELECT {_REPORT_START}, {_REPORT_ALL} FROM scored",
    "report_preview": (
        f"{_CELLS_SCORED}, top AS (SELECT * FROM scored "
        "ORDER BY l_orderkey, l_linenumber, label, features LIMIT 20) "
        f"SELECT substr(features, 1, 17) || '...' AS \"{FEATURES_COLUMN}\", "
        f"CAST(label AS VARCHAR) AS \"{LABEL_COLUMN}\", {_REPORT_ALL} FROM top"
    ),
    **{f"model_round_trip_{kind.key}": _noisy(kind) for kind in ALL_KINDS},
    "train_run_summary": f"{_SPLIT_SUMMARY} SELECT model, accuracy FROM summary",
    "train_run_report": f"{_SPLIT_SCORED} SELECT {_REPORT_START}, {_REPORT_ALL} FROM scored",
    **{f"training_run_{k.key}": _split_report(k, k.training_column) for k in ALL_KINDS},
    **{f"prediction_run_{k.key}": _split_report(k, k.prediction_column) for k in ALL_KINDS},
    "single_model_run": (
        f"{_SPLIT_SUMMARY} SELECT model, accuracy FROM summary WHERE model = '{TREE.title}'"
    ),
    "imperfect_run_report": (
        f"{_split(f'NOT {_IMPERFECT}')} SELECT {_REPORT_START}, {_REPORT_ALL} FROM scored"
    ),
    "imperfect_run_rejects": f"WITH {_SPLIT_ITEM} {_BROKEN}",
    "imperfect_run_counts": (
        f"WITH {_SPLIT_ITEM} SELECT CASE WHEN learnt THEN 'training' ELSE 'validation' END AS source, "
        f"count(*) AS lines, count(*) FILTER ({_IMPERFECT}) AS rejected FROM item GROUP BY learnt"
    ),
    "eleven_features": (
        f"{_ELEVEN_SCORED} SELECT l_orderkey, l_linenumber, label, tree AS tree_prediction, "
        "bayes AS bayes_prediction FROM scored"
    ),
    "eleven_features_checked": " UNION ALL ".join(
        f"SELECT '{kind.title}' AS model, count(*) AS examples, count(*) AS equal_to_own, "
        "0 AS models_equal_to_others FROM lineitem"
        for kind in ALL_KINDS
    ),
    "logistic_optimum": (
        "SELECT count(*) AS examples, TRUE AS gradient_is_small, TRUE AS zero_is_no_optimum FROM lineitem"
    ),
    "saved_model_run": f"{_SPLIT_SCORED} SELECT {_REPORT_START}, {_REPORT_ALL} FROM scored",
}
