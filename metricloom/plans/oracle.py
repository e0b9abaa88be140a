"""Independent SQL for the registered queries, for a check on another engine.

Plain statements of what each operator means, written without regard to speed.
"""

from __future__ import annotations

# Fixed values, written out here so that a slip in the package's own shows up.
HART_NUMERATOR = [
    0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
HART_DENOMINATOR = [
    0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]
HART_SWITCH = 7.07106781186547
AS241_CENTRE = (
    [
    2509.0809287301227, 33430.57558358813, 67265.7709270087, 45921.95393154987,
    13731.69376550946, 1971.5909503065513, 133.14166789178438, 3.3871328727963665,
],
    [
    5226.495278852854, 28729.085735721943, 39307.89580009271, 21213.794301586597,
    5394.196021424751, 687.1870074920579, 42.31333070160091, 1.0,
],
)
AS241_MIDDLE = (
    [
    0.0007745450142783414, 0.022723844989269184, 0.2417807251774506, 1.2704582524523684,
    3.6478483247632045, 5.769497221460691, 4.630337846156546, 1.4234371107496835,
],
    [
    1.0507500716444169e-09, 0.0005475938084995345, 0.015198666563616457, 0.14810397642748008,
    0.6897673349851, 1.6763848301838038, 2.053191626637759, 1.0,
],
)
AS241_TAIL = (
    [
    2.0103343992922881e-07, 2.7115555687434876e-05, 0.0012426609473880784, 0.026532189526576124,
    0.29656057182850487, 1.7848265399172913, 5.463784911164114, 6.657904643501103,
],
    [
    2.0442631033899397e-15, 1.421511758316446e-07, 1.8463183175100548e-05, 0.0007868691311456133,
    0.014875361290850615, 0.1369298809227358, 0.599832206555888, 1.0,
],
)
SW_LAST = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
SW_LAST_BUT_ONE = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_MEAN_LARGE = [-1.5861, -0.31082, -0.083751, 0.0038915]
SW_SD_LARGE = [-0.4803, -0.082676, 0.0030302]
CORRECTIVE_MESSAGE = (
    r"\b(fix(e[ds])?|fixup|bugfix|hotfix|bug(s)?|defect|patch|"
    r"error|fault|fail(ure|ed|s)?|issue|resolve[ds]?|resolving|"
    r"correct(ed|ion|s)?|repair(ed|s)?|workaround|revert)\b"
    r"|"
    r"\b(close[sd]?|fix(e[sd])?|resolve[sd]?)\s*#\d+"
)

METRICS = [
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "p_size",
    "p_retailprice",
]

METRIC = """metric AS (
  SELECT l_orderkey AS id, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_shipdate,
         l_quantity::DOUBLE AS l_quantity, l_extendedprice::DOUBLE AS l_extendedprice,
         l_discount::DOUBLE AS l_discount, l_tax::DOUBLE AS l_tax,
         nullif(l_linenumber, 7)::DOUBLE AS l_linenumber,
         p_size::DOUBLE AS p_size, p_retailprice::DOUBLE AS p_retailprice,
         3.0::DOUBLE AS "constant", NULL::DOUBLE AS "empty"
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

CHANGES = """changes AS (
  SELECT r_name AS repo, o_orderkey AS hash,
         datediff('day', DATE '1970-01-01', o_orderdate::DATE)::BIGINT * 100000000000000 + o_orderkey
           AS commit_seq,
         o_orderstatus = 'P' AND o_orderkey % 10 = 0 AS merge, c_name AS author,
         o_orderdate AS committer_date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Fix crash #' || o_orderkey
              WHEN '2-HIGH' THEN 'closes #' || o_orderkey
              ELSE 'update ' || o_orderpriority END AS msg,
         (CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_brand || '/' || p_type || '/' END)
           || 'f' || l_partkey || (CASE WHEN p_size % 4 = 0 THEN '.txt' ELSE '.py' END) AS path,
         l_quantity::BIGINT AS added,
         (CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE 0 END)::BIGINT AS deleted,
         nullif(p_size, 50)::BIGINT AS nloc, l_linenumber AS line_id,
         l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       JOIN part ON l_partkey = p_partkey)"""

VALID = """valid AS (SELECT * FROM changes WHERE NOT merge AND path <> '')"""

COMMITS = """commits AS (
  SELECT repo, hash, min(commit_seq) AS commit_seq, min(author) AS author,
         min(committer_date) AS committer_date, min(msg) AS msg
  FROM valid GROUP BY repo, hash)"""

LINES = """lines AS (
  SELECT repo, hash, commit_seq, path, line_id,
         CASE WHEN deleted = 0 THEN 'write' ELSE 'delete' END AS op,
         CASE line_id % 3 WHEN 0 THEN '# note' WHEN 1 THEN '' ELSE 'x = 1' END AS content
  FROM changes WHERE NOT merge)"""

LOG = """log AS (
  SELECT event_id AS hash, user_id AS author, ts AS committer_date, event_type AS msg,
         (props->>'$.k')::BIGINT % 5 AS repo, value AS churn, (event_type = 'error')::INT AS label
  FROM events)"""

SCORED = """scored AS (
  SELECT event_id AS id, ts AS date, value / 500.0::DOUBLE AS score,
         (event_type = 'error')::INT AS label FROM events)"""


def rounded(x: str, digits: int) -> str:
    return f"round_even(({x})::DOUBLE * 1e{digits}, 0) / 1e{digits}"


def long(cols=METRICS, source: str = "metric") -> str:
    parts = [f"SELECT '{c}' AS variable, {c}::DOUBLE AS value FROM {source}" for c in cols]
    return "long AS (" + " UNION ALL ".join(parts) + ")"


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def quantile(p: float, x: str = "value") -> str:
    return f"quantile_cont({x}::DOUBLE, {p}::DOUBLE)"


def horner(coefficients, x: str) -> str:
    text = f"{coefficients[0]!r}::DOUBLE"
    for c in coefficients[1:]:
        text = f"(({x}) * {text} + {c!r}::DOUBLE)"
    return text


def phi(x: str) -> str:
    a = f"abs({x})"
    near = (
        f"exp(-{a} * {a} / 2.0::DOUBLE) * {horner(HART_NUMERATOR, a)} / {horner(HART_DENOMINATOR, a)}"
    )
    chain = f"({a} + 0.65::DOUBLE)"
    for k in (4.0, 3.0, 2.0, 1.0):
        chain = f"({a} + {k}::DOUBLE / {chain})"
    far = f"exp(-{a} * {a} / 2.0::DOUBLE) / {chain} / 2.506628274631::DOUBLE"
    low = f"(CASE WHEN {a} > 37 THEN 0.0::DOUBLE WHEN {a} < {HART_SWITCH}::DOUBLE THEN {near} ELSE {far} END)"
    return f"(CASE WHEN {x} > 0 THEN 1.0::DOUBLE - {low} ELSE {low} END)"


def probit(p: str) -> str:
    q = f"({p} - 0.5::DOUBLE)"
    r = f"(0.180625::DOUBLE - {q} * {q})"
    root = f"sqrt(-ln(least({p}, 1.0::DOUBLE - {p})))"
    centre = f"{q} * {horner(AS241_CENTRE[0], r)} / {horner(AS241_CENTRE[1], r)}"
    m, t = f"({root} - 1.6::DOUBLE)", f"({root} - 5.0::DOUBLE)"
    outer = (
        f"(CASE WHEN {root} <= 5 THEN {horner(AS241_MIDDLE[0], m)} / {horner(AS241_MIDDLE[1], m)} "
        f"ELSE {horner(AS241_TAIL[0], t)} / {horner(AS241_TAIL[1], t)} END)"
    )
    return f"(CASE WHEN abs({q}) <= 0.425 THEN {centre} WHEN {q} < 0 THEN -{outer} ELSE {outer} END)"


WORD = r"[\p{L}\p{M}\p{N}_]"
_words, _numbered = CORRECTIVE_MESSAGE.split(r"|\b(close")
_words = _words.removeprefix(r"\b").removesuffix(r"\b")
FIX_PATTERN = (
    r"(?i)(^|[^\p{L}\p{M}\p{N}_])(" + _words + r"($|[^\p{L}\p{M}\p{N}_])|(close" + _numbered + ")"
)
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

SQL: dict[str, str] = {}


# --- sources and sinks ------------------------------------------------------------------

SQL["csv_metric_scan"] = """
SELECT l_returnflag, l_linestatus, l_orderkey::DOUBLE AS l_orderkey, l_quantity::DOUBLE AS l_quantity,
       l_extendedprice::DOUBLE AS l_extendedprice, nullif(l_linenumber, 7)::DOUBLE AS l_linenumber
FROM lineitem"""

SQL["csv_lenient_scan"] = """
SELECT event_id::VARCHAR AS "key",
       CASE WHEN event_id % 7 <> 0 AND event_id % 3 = 0 THEN event_type || ',' || chr(10) || '"x"'
            ELSE event_type END AS kind,
       CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 3 = 0 THEN '2' ELSE '3' END AS size
FROM events WHERE event_id % 10 <> 0"""
SQL["csv_lenient_one_column"] = """
SELECT CASE WHEN event_id % 7 <> 0 AND event_id % 3 = 0 THEN event_type || ',"x"' ELSE event_type END AS kind
FROM events WHERE event_id % 10 <> 0"""

SQL["incremental_ingest"] = with_(LOG) + "SELECT repo, hash, author FROM log"

BALANCE = f"""SELECT repo, sum(label)::BIGINT AS positive, count(label) AS total,
  {rounded("sum(label) * 100.0::DOUBLE / count(label)", 4)} AS pct_positive FROM log"""

SQL["group_balance"] = with_(LOG) + BALANCE + " GROUP BY repo"
SQL["result_sink"] = SQL["group_balance"]
SQL["balance_rollup"] = (
    with_(LOG) + BALANCE.replace("SELECT repo,", "SELECT coalesce(repo::VARCHAR, 'all') AS repo,")
    + " GROUP BY ROLLUP (log.repo)"
)

SQL["feature_scan"] = with_(LOG) + f"""
SELECT hash, epoch(date_trunc('second', committer_date))::BIGINT AS committed,
       {rounded("ln(1 + churn)", 6)} AS churn_log FROM log WHERE hash % 9 <> 0"""


# --- cleaning ---------------------------------------------------------------------------

SQL["coerce_numeric"] = """
SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL
  WHEN event_id % 13 = 0 THEN 12.5::DOUBLE WHEN event_id % 17 = 0 THEN NULL
  ELSE value END AS value FROM events"""

SQL["coerce_timestamp"] = """
SELECT event_id AS hash, epoch(date_trunc('second', ts))::BIGINT - 7200 AS at
FROM events WHERE event_id % 5 <> 0"""

_incomplete = " AND ".join(f"{c} IS NOT NULL" for c in METRICS)
SQL["drop_incomplete"] = with_(METRIC) + f"""
SELECT id, l_partkey, l_linenumber, 'subset' AS rule FROM metric WHERE l_linenumber IS NOT NULL
UNION ALL
SELECT id, l_partkey, l_linenumber, 'every' AS rule FROM metric WHERE {_incomplete}"""

SQL["dedup_keep_first"] = with_(LOG) + """
SELECT author, hash, msg, churn FROM (
  SELECT *, row_number() OVER (PARTITION BY author ORDER BY committer_date, hash) AS rn FROM log)
WHERE rn = 1"""

SQL["maturity_filter"] = with_(LOG) + """
SELECT hash, author FROM log WHERE committer_date < TIMESTAMP '2024-07-15' - INTERVAL 180 DAYS"""

SQL["ensure_features"] = with_(METRIC) + """
SELECT id, l_partkey, coalesce(l_linenumber, 0.0::DOUBLE) AS l_linenumber, 0.0::DOUBLE AS absent
FROM metric"""

SQL["drop_constant_columns"] = (
    with_(METRIC, long([*METRICS, '"constant"', '"empty"']).replace("'\"", "'").replace("\"'", "'"))
    + """
SELECT variable, 'distinct' AS rule FROM long GROUP BY variable HAVING count(DISTINCT value) <= 1
UNION ALL
SELECT variable, 'deviation' AS rule FROM long GROUP BY variable HAVING stddev_samp(value) = 0"""
)

SQL["select_columns"] = with_(METRIC) + "SELECT id, l_quantity, p_size FROM metric"

SQL["clamp_label"] = """
SELECT l_orderkey, l_partkey,
  least(greatest(trunc(coalesce(nullif(l_linenumber, 7) * 0.75 - 1.5, 0)), 0), 1)::INT AS label
FROM lineitem"""

SQL["binarize"] = with_(METRIC) + """
SELECT id, l_partkey, (l_linenumber - 3 > 0)::INT AS positive FROM metric
WHERE l_linenumber IS NOT NULL"""

SQL["message_head"] = f"""
SELECT doc_id, trim(regexp_replace(substring(text, 1, 120), '{SPACES}+', ' ', 'g')) AS head
FROM documents"""

SQL["path_parts"] = """
WITH p AS (SELECT p_partkey,
  (CASE WHEN p_partkey % 10 = 0 THEN '' ELSE p_brand || '/' || p_type || '/' END)
   || 'f' || p_partkey || (CASE WHEN p_size % 4 = 0 THEN '.txt' ELSE '.py' END) AS path FROM part)
SELECT p_partkey, path, split_part(path, '/', 1) AS subsystem,
  CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*)/[^/]*$', 1) ELSE '' END AS directory,
  suffix(path, '.py') AS is_python FROM p"""

SQL["author_key"] = """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'a' || c_custkey || '@x'
  WHEN c_custkey % 2 = 0 THEN c_name ELSE 'unknown' END AS author FROM customer"""

SQL["fix_flag"] = f"""
SELECT doc_id, regexp_matches(text, '{FIX_PATTERN}')::INT AS fix FROM documents"""

SQL["commit_filter"] = with_(CHANGES) + """
SELECT repo, hash, count(*) AS files FROM changes WHERE NOT merge AND path <> '' GROUP BY repo, hash"""

SQL["meaningful_line"] = f"""
SELECT doc_id, count(*) AS lines,
  count(*) FILTER (WHERE NOT regexp_matches(line, '^{SPACES}*(#.*)?$')) AS meaningful
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id"""


# --- row features -----------------------------------------------------------------------

SIZED = """sized AS (SELECT id, l_partkey, l_quantity - 10 AS la, l_linenumber AS ld, p_size - 5 AS lt
  FROM metric)"""
_clip = "(CASE WHEN {0} IS NOT NULL THEN greatest({0}, 0) END)"
_la, _ld = _clip.format("la"), _clip.format("ld")
_rla, _rld = f"{_la} / greatest(lt, 1)", f"{_ld} / greatest(lt, 1)"

SQL["churn"] = with_(METRIC, SIZED) + f"SELECT id, l_partkey, {_la} + {_ld} AS churn FROM sized"
SQL["size_ratios"] = with_(METRIC, SIZED) + f"""
SELECT id, l_partkey, {rounded(_rla, 9)} AS "LA_ratio", {rounded(_rld, 9)} AS "LD_ratio" FROM sized"""
SQL["log1p_bank"] = with_(METRIC, SIZED) + "SELECT id, l_partkey, " + ", ".join(
    f'{rounded(f"ln(1 + {x})", 9)} AS "{name}_log"'
    for name, x in (
        ("LA", _la), ("LD", _ld), ("LT", _clip.format("lt")), ("churn", f"({_la} + {_ld})"),
        ("LA_ratio", _rla), ("LD_ratio", _rld),
    )
) + " FROM sized"

SQL["unpivot_metrics"] = with_(METRIC, long()) + "SELECT variable, value FROM long"

SQL["standardize"] = with_(METRIC) + f""", t AS (
  SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(p_size) AS pm, stddev_pop(p_size) AS ps
  FROM metric WHERE l_returnflag = 'A')
SELECT id, l_partkey, {rounded("(l_quantity - qm) / qs", 6)} AS l_quantity_std,
  {rounded("(p_size - pm) / ps", 6)} AS p_size_std FROM metric, t"""

SQL["zscore"] = with_(METRIC) + f""", t AS (
  SELECT avg(l_linenumber) AS m, stddev_samp(l_linenumber) AS s FROM metric)
SELECT id, l_partkey, {rounded("(l_linenumber - m) / s", 6)} AS l_linenumber_z,
  "constant" AS constant_z FROM metric, t"""


# --- change history ---------------------------------------------------------------------

_dir = "(CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*)/[^/]*$', 1) ELSE '' END)"

DIFFUSION = f"""diffusion AS (
  WITH per AS (SELECT *, added + deleted AS c, sum(added + deleted) OVER (PARTITION BY repo, hash) AS t,
                      count(*) OVER (PARTITION BY repo, hash) AS nf FROM valid)
  SELECT repo, hash, count(DISTINCT split_part(path, '/', 1)) AS "NS", count(DISTINCT {_dir}) AS "ND",
         count(*) AS "NF",
         {rounded('''CASE WHEN max(nf) <= 1 OR max(t) = 0 THEN 0 ELSE
            coalesce(sum(CASE WHEN c > 0 THEN -(c::DOUBLE / t) * log2(c::DOUBLE / t) END), 0)
              / log2(max(nf)) END''', 6)} AS "Entropy"
  FROM per GROUP BY repo, hash)"""
SIZE = f"""size AS (
  SELECT repo, hash, sum(added)::BIGINT AS "LA", sum(deleted)::BIGINT AS "LD",
         {rounded("coalesce(avg(CASE WHEN nloc >= 0 THEN nloc::DOUBLE END), 0)", 2)} AS "LT"
  FROM valid GROUP BY repo, hash)"""
PURPOSE = """purpose AS (
  SELECT repo, hash, max((msg LIKE 'Fix crash%' OR msg LIKE 'closes #%')::INT) AS "FIX"
  FROM valid GROUP BY repo, hash)"""
HISTORY = f"""firsts AS (
  SELECT *, row_number() OVER (PARTITION BY repo, path, author ORDER BY commit_seq) = 1 AS is_first
  FROM valid), past AS (
  SELECT repo, hash, committer_date,
    coalesce(sum(is_first::INT) OVER w, 0) AS devs, count(*) OVER w AS nuc,
    arg_max(committer_date, commit_seq) OVER w AS last_date
  FROM firsts WINDOW w AS (PARTITION BY repo, path ORDER BY commit_seq
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), history AS (
  SELECT repo, hash, {rounded("avg(devs)", 2)} AS "NDEV",
    {rounded('''coalesce(avg(CASE WHEN last_date IS NOT NULL THEN
       greatest((epoch(committer_date) - epoch(last_date)) / 86400.0, 0) END), 0)''', 2)} AS "AGE",
    {rounded("avg(nuc)", 2)} AS "NUC"
  FROM past GROUP BY repo, hash)"""
EXPERIENCE = f"""exp_rows AS (
  SELECT repo, hash,
    row_number() OVER (PARTITION BY repo, author ORDER BY commit_seq) - 1 AS exp,
    coalesce(sum(1.0::DOUBLE / (1.0 + greatest(epoch(TIMESTAMP '2002-01-01') - epoch(committer_date), 0)
        / 86400.0 / 365.25)) OVER (PARTITION BY repo, author ORDER BY commit_seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rexp
  FROM commits), areas AS (
  SELECT DISTINCT repo, hash, author, commit_seq, split_part(path, '/', 1) AS area FROM valid), sexp AS (
  SELECT repo, hash, sum(b)::BIGINT AS "SEXP" FROM (
    SELECT repo, hash, row_number() OVER (PARTITION BY repo, author, area ORDER BY commit_seq) - 1 AS b
    FROM areas) GROUP BY repo, hash), experience AS (
  SELECT e.repo, e.hash, exp::BIGINT AS "EXP", {rounded("rexp", 4)} AS "REXP", "SEXP"
  FROM exp_rows e JOIN sexp USING (repo, hash))"""

SQL["kamei_diffusion"] = with_(CHANGES, VALID, DIFFUSION) + "SELECT * FROM diffusion"
SQL["kamei_size"] = with_(CHANGES, VALID, SIZE) + "SELECT * FROM size"
SQL["kamei_purpose"] = with_(CHANGES, VALID, PURPOSE) + "SELECT * FROM purpose"
SQL["kamei_history"] = with_(CHANGES, VALID, HISTORY) + "SELECT * FROM history"
SQL["kamei_experience"] = with_(CHANGES, VALID, COMMITS, EXPERIENCE) + "SELECT * FROM experience"
ALL_FEATURES = (CHANGES, VALID, COMMITS, DIFFUSION, SIZE, PURPOSE, HISTORY, EXPERIENCE)
SQL["change_features"] = with_(*ALL_FEATURES) + """
SELECT repo, hash, author, epoch(committer_date)::BIGINT AS committer_date, msg AS msg_head,
  "NS", "ND", "NF", "Entropy", "LA", "LD", "LT", "FIX", "NDEV", "AGE", "NUC", "EXP", "REXP", "SEXP"
FROM commits JOIN diffusion USING (repo, hash) JOIN size USING (repo, hash)
  JOIN purpose USING (repo, hash) JOIN history USING (repo, hash) JOIN experience USING (repo, hash)"""


# --- labelling --------------------------------------------------------------------------

CANDIDATES = """candidates AS (
  SELECT DISTINCT repo, hash, path FROM valid f
  WHERE (msg LIKE 'Fix crash%' OR msg LIKE 'closes #%') AND path LIKE '%.py' AND deleted > 0
    AND EXISTS (SELECT 1 FROM lines l WHERE l.repo = f.repo AND l.hash = f.hash
    AND l.path = f.path AND l.op = 'delete' AND l.content = 'x = 1'))"""
ORIGINS = """dels AS (
  SELECT l.*, row_number() OVER () AS rid FROM lines l JOIN candidates c USING (repo, hash, path)
  WHERE op = 'delete'), origins AS (
  SELECT d.repo, d.hash AS fix_hash, d.path, d.line_id, arg_max(w.hash, w.commit_seq) AS origin
  FROM dels d JOIN lines w ON w.repo = d.repo AND w.path = d.path AND w.line_id = d.line_id
    AND w.op = 'write' AND w.commit_seq < d.commit_seq
  GROUP BY d.rid, d.repo, d.hash, d.path, d.line_id)"""
LABELS = """labels_out AS (
  SELECT p.repo, p.hash, "FIX", (o.origin IS NOT NULL)::INT AS is_buggy
  FROM purpose p LEFT JOIN (SELECT DISTINCT repo, origin FROM origins) o
    ON o.repo = p.repo AND o.origin = p.hash)"""
TRACE = (CHANGES, VALID, LINES, CANDIDATES)

SQL["szz_candidates"] = with_(*TRACE) + "SELECT repo, hash, path FROM candidates"
SQL["szz_origin"] = with_(*TRACE, ORIGINS) + "SELECT * FROM origins"
SQL["szz_label"] = with_(*TRACE, ORIGINS, PURPOSE, LABELS) + "SELECT * FROM labels_out"
SQL["szz_report"] = with_(*TRACE, ORIGINS, PURPOSE, LABELS) + f"""
SELECT repo, count(*) AS commits, sum("FIX")::BIGINT AS fixes, sum(is_buggy)::BIGINT AS labelled,
  {rounded("sum(is_buggy) * 100.0 / count(*)", 1)} AS rate_pct FROM labels_out GROUP BY repo"""

SQL["build_dataset"] = with_(
    CHANGES, VALID, COMMITS, SIZE, PURPOSE, HISTORY, EXPERIENCE, LINES, CANDIDATES, ORIGINS, LABELS
) + f"""
SELECT s.repo, s.hash, ("LA" + "LD")::DOUBLE AS churn, is_buggy,
  {rounded('ln(1 + "LA"::DOUBLE)', 6)} AS "LA_log", {rounded('ln(1 + "NDEV")', 6)} AS "NDEV_log",
  {rounded('ln(1 + "REXP")', 6)} AS "REXP_log",
  {rounded('ln(1 + "LD" / greatest("LT", 1))', 6)} AS "LD_ratio_log"
FROM size s JOIN history USING (repo, hash) JOIN experience USING (repo, hash)
  JOIN labels_out USING (repo, hash) JOIN commits USING (repo, hash)
WHERE committer_date < TIMESTAMP '2002-01-01' - INTERVAL 180 DAYS"""


# --- joins, unions, order ---------------------------------------------------------------

SQL["annotate_join"] = with_(METRIC) + f""", l AS (
  SELECT id, 'l_quantity' AS variable, l_quantity AS value FROM metric UNION ALL
  SELECT id, 'p_size' AS variable, p_size AS value FROM metric), s AS (
  SELECT variable, {rounded(f"{quantile(0.75)} - {quantile(0.25)}", 2)} AS iqr FROM l GROUP BY variable)
SELECT variable, id, value, iqr FROM l LEFT JOIN s USING (variable)"""

SQL["aligned_join"] = with_(LOG) + "SELECT hash, author, churn FROM log"

SQL["key_lookup"] = """
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""

SQL["tagged_union"] = with_(LOG) + (
    BALANCE.replace("SELECT repo,", "SELECT 'all' AS split, repo,") + " GROUP BY repo UNION ALL "
    + BALANCE.replace("SELECT repo,", "SELECT 'small' AS split, repo,") + " WHERE churn < 20 GROUP BY repo"
)

SQL["pivot_metric"] = with_(LOG) + "SELECT repo, " + ", ".join(
    f"""{rounded(f"avg(churn) FILTER (WHERE msg = '{k}')", 4)} AS "{k}" """
    for k in ("click", "error", "purchase", "signup", "view")
) + " FROM log GROUP BY repo"

SQL["chrono_sort"] = """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS "position" FROM orders"""

SQL["top_extremes"] = with_(LOG) + f""", f AS (
  SELECT {rounded(f"{quantile(0.75, 'churn')} + 1.5 * ({quantile(0.75, 'churn')} - {quantile(0.25, 'churn')})", 2)}
    AS bound FROM log)
SELECT hash, churn, author, repo FROM log, f WHERE churn > bound ORDER BY churn DESC, hash LIMIT 10"""


# --- profiling --------------------------------------------------------------------------

MODES = """modes AS (
  SELECT variable, value AS mode FROM (
    SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, value) AS rn
    FROM long WHERE value IS NOT NULL GROUP BY variable, value) WHERE rn = 1)"""

SQL["central_tendency"] = with_(METRIC, long(), MODES) + f"""
SELECT variable, {rounded("avg(value)", 3)} AS mean, {rounded(quantile(0.5), 3)} AS median,
  {rounded("any_value(mode)", 3)} AS mode FROM long JOIN modes USING (variable) GROUP BY variable"""

_seen = ["l_quantity", "p_size", "l_tax"]
_seen_long = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS value, "
    "id * 1000000000 + l_partkey * 1000 + l_suppkey % 1000 AS place FROM metric"
    for c in _seen
)
SQL["central_tendency_first_seen"] = with_(METRIC) + f""", long AS ({_seen_long}), modes AS (
  SELECT variable, value AS mode FROM (SELECT variable, value, row_number() OVER (
    PARTITION BY variable ORDER BY count(*) DESC, min(place)) AS rn
  FROM long WHERE value IS NOT NULL GROUP BY variable, value) WHERE rn = 1)
SELECT variable, {rounded("avg(value)", 3)} AS mean, {rounded(quantile(0.5), 3)} AS median,
  {rounded("any_value(mode)", 3)} AS mode FROM long JOIN modes USING (variable) GROUP BY variable"""

SQL["skew_class"] = with_(METRIC, long()) + f""", r AS (
  SELECT variable, CASE WHEN {quantile(0.5)} = 0 THEN 'infinity'::DOUBLE
    ELSE avg(value) / {quantile(0.5)} END AS ratio FROM long GROUP BY variable)
SELECT variable, {rounded("ratio", 4)} AS ratio, CASE WHEN ratio > 1.5 THEN 'strong right skew'
  WHEN ratio > 1.1 THEN 'mild right skew' ELSE 'symmetric' END AS skew_class FROM r"""

_cv = "CASE WHEN avg(value) <> 0 THEN stddev_samp(value) * 100 / avg(value) END"
SQL["dispersion"] = with_(METRIC, long()) + f"""
SELECT variable, {rounded("max(value) - min(value)", 3)} AS "range",
  {rounded("var_samp(value)", 3)} AS variance, {rounded("stddev_samp(value)", 3)} AS std_dev,
  {rounded(_cv, 2)} AS cv_pct FROM long GROUP BY variable"""

SQL["cv_class"] = with_(METRIC, long()) + f""", c AS (
  SELECT variable, {_cv} AS cv FROM long GROUP BY variable)
SELECT variable, {rounded("cv", 1)} AS cv_pct, CASE WHEN cv > 150 THEN 'extreme' WHEN cv > 80 THEN 'high'
  WHEN cv > 30 THEN 'moderate' ELSE 'low' END AS cv_class FROM c"""

_seven = {"p5": 0.05, "p10": 0.1, "q1": 0.25, "median": 0.5, "q3": 0.75, "p90": 0.9, "p95": 0.95}
SQL["percentiles"] = with_(METRIC, long()) + "SELECT variable, " + ", ".join(
    f"{rounded(quantile(p), 3)} AS {n}" for n, p in _seven.items()
) + f", {rounded(f'{quantile(0.75)} - {quantile(0.25)}', 3)} AS iqr FROM long GROUP BY variable"

QUARTILES = f"""quartiles AS (
  SELECT variable, {quantile(0.25)} AS q1, {quantile(0.5)} AS median, {quantile(0.75)} AS q3
  FROM long GROUP BY variable), fences AS (
  SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM quartiles)"""
_fence_select = "SELECT variable, " + ", ".join(
    f"{rounded(f'any_value({c})', 2)} AS {c}" for c in ("q1", "q3", "iqr", "lower", "upper")
) + f""", count(*) FILTER (WHERE value < lower) AS n_low, count(*) FILTER (WHERE value > upper) AS n_high,
  {rounded("count(*) FILTER (WHERE value < lower OR value > upper) * 100.0 / count(*)", 1)} AS pct_outliers
  FROM long JOIN fences USING (variable) GROUP BY variable"""
SQL["outlier_fences"] = with_(METRIC, long(), QUARTILES) + _fence_select
SQL["outlier_fences_skewed"] = with_(LOG, long(["churn"], "log"), QUARTILES) + _fence_select

_long_both = long()[:-1] + " UNION ALL SELECT 'churn' AS variable, churn AS value FROM log)"
SQL["box_summary"] = with_(METRIC, LOG, _long_both, QUARTILES) + f""", b AS (
  SELECT variable, {rounded("any_value(q1)", 3)} AS q1, {rounded("any_value(median)", 3)} AS median,
    {rounded("any_value(q3)", 3)} AS q3, {rounded("avg(value)", 3)} AS mean,
    min(value) FILTER (WHERE value BETWEEN lower AND upper) AS whisker_low,
    max(value) FILTER (WHERE value BETWEEN lower AND upper) AS whisker_high,
    count(*) FILTER (WHERE value < lower OR value > upper) AS n_outliers, count(*) AS n
  FROM long JOIN fences USING (variable) GROUP BY variable)
SELECT * EXCLUDE (n), format('{{}} out. ({{:.1f}}%)', n_outliers,
  {rounded("n_outliers * 100.0 / n", 1)}) AS label FROM b"""

SQL["describe_skew"] = with_(METRIC, long()) + f"""
SELECT variable, count(value) AS count, {rounded("avg(value)", 4)} AS mean,
  {rounded("stddev_samp(value)", 4)} AS std, {rounded("min(value)", 4)} AS min,
  {rounded(quantile(0.25), 4)} AS p25, {rounded(quantile(0.5), 4)} AS p50,
  {rounded(quantile(0.75), 4)} AS p75, {rounded("max(value)", 4)} AS max,
  {rounded("skewness(value)", 4)} AS skew FROM long GROUP BY variable"""

SQL["overall_balance"] = with_(LOG) + f"""
SELECT count(label) AS total, count(*) FILTER (WHERE label = 1) AS positive,
  count(*) FILTER (WHERE label <> 1) AS negative,
  {rounded("count(*) FILTER (WHERE label = 1) * 100.0 / count(label)", 1)} AS pct_positive FROM log"""

SQL["value_frequency"] = with_(METRIC) + """
SELECT l_linenumber AS value, count(*) AS n FROM metric WHERE l_linenumber IS NOT NULL GROUP BY 1"""


def histogram_sql(bins: int) -> str:
    return f""", b AS (
  SELECT variable, min(value) AS low, max(value) AS high, count(value) AS size,
    (max(value) - min(value)) / {bins}.0::DOUBLE AS width FROM long GROUP BY variable), h AS (
  SELECT variable, least(coalesce(CASE WHEN width > 0 THEN floor((value - low) / width) END, 0),
    {bins - 1})::INT AS bin, count(*) AS n FROM long JOIN b USING (variable)
  WHERE value IS NOT NULL GROUP BY 1, 2), f AS (
  SELECT b.*, unnest(range({bins}))::INT AS bin FROM b WHERE size > 0)
SELECT variable, bin, {rounded("low + bin * width", 6)} AS left_edge, coalesce(n, 0) AS n,
  {rounded("CASE WHEN width > 0 THEN coalesce(n, 0) / (size * width) END", 9)} AS density
FROM f LEFT JOIN h USING (variable, bin)"""


SQL["histogram"] = with_(
    METRIC, long()[:-1] + " UNION ALL SELECT 'constant' AS variable, \"constant\" AS value FROM metric)"
) + histogram_sql(30)


SQL["kde_curve"] = with_(METRIC, long(["l_quantity", "p_size", "p_retailprice"])) + f""", s AS (
  SELECT variable, min(value) AS low, max(value) AS high, count(value) AS n,
    stddev_samp(value) * pow(count(value), -0.2) AS h FROM long GROUP BY variable), g AS (
  SELECT *, unnest(range(50)) AS point FROM s), v AS (
  SELECT variable, value, count(*) AS c FROM long WHERE value IS NOT NULL GROUP BY 1, 2), k AS (
  SELECT variable, point, low + point * ((high - low) / 49) AS x, value, c, n, h
  FROM g JOIN v USING (variable))
SELECT variable, point::INT AS point, {rounded("any_value(x)", 6)} AS x,
  {rounded("sum(c * exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))", 8)}
    AS density FROM k GROUP BY 1, 2"""

_KDE_CELLS = 512
SQL["kde_curve_binned"] = with_(METRIC, long(["l_quantity", "l_extendedprice"])) + f""", s AS (
  SELECT variable, min(value) AS low, max(value) AS high, count(value) AS n, 0.9 * pow(count(value), -0.2)
    * least(stddev_samp(value), (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34) AS h
  FROM long GROUP BY variable), p AS (
  SELECT variable, low, (high - low) / {_KDE_CELLS - 1} AS w, (value - low) / ((high - low) / {_KDE_CELLS - 1}) AS place
  FROM long JOIN s USING (variable) WHERE value IS NOT NULL), l AS (
  SELECT *, least(floor(place), {_KDE_CELLS - 2}) AS cell FROM p), c AS (
  SELECT variable, low + cell * w AS value, cell + 1 - place AS share FROM l UNION ALL
  SELECT variable, low + (cell + 1) * w, place - cell FROM l), v AS (
  SELECT variable, value, sum(share) AS c FROM c GROUP BY 1, 2), g AS (
  SELECT *, low - 3 * h AS start, (high - low + 6 * h) / 511 AS step, unnest(range(512)) AS point FROM s), k AS (
  SELECT variable, point, start + point * step AS x, value, c, n, h FROM g JOIN v USING (variable))
SELECT variable, point::INT AS point, {rounded("any_value(x)", 6)} AS x,
  {rounded("sum(c * exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))", 8)}
    AS density FROM k GROUP BY 1, 2"""

_profile = [*METRICS, "empty"]
SQL["profile_all"] = with_(
    METRIC, long()[:-1] + " UNION ALL SELECT 'empty' AS variable, \"empty\" AS value FROM metric)"
) + f"""
SELECT variable, count(value) AS n, count(*) - count(value) AS n_missing,
  {rounded("avg(value)", 4)} AS mean, {rounded("stddev_samp(value)", 4)} AS std,
  {rounded("min(value)", 4)} AS min, {rounded("max(value)", 4)} AS max,
  {rounded("sum(value)", 4)} AS total FROM long GROUP BY variable"""


# --- tests and correlation --------------------------------------------------------------

ECDF = """d AS (
  SELECT variable, value, (value - m) / s AS z, n, row_number() OVER (PARTITION BY variable ORDER BY value) AS i
  FROM long JOIN (SELECT variable, avg(value) AS m, stddev_samp(value) AS s, count(value) AS n
                  FROM long GROUP BY variable) USING (variable) WHERE value IS NOT NULL), ks AS (
  SELECT variable, max(n) AS n, max(greatest(i::DOUBLE / n - p, p - (i - 1)::DOUBLE / n)) AS d
  FROM (SELECT *, PHI AS p FROM d) GROUP BY variable)""".replace("PHI", phi("z"))

def shapiro_sql(source: str, name: str) -> str:
    """CTEs that end in ``name`` (variable, n, w, p), on all present values of ``source``."""
    u = "(1.0::DOUBLE / sqrt(n))"
    last, second = probit("((n - 0.375::DOUBLE) / (n + 0.25::DOUBLE))"), probit(
        "((n - 1.375::DOUBLE) / (n + 0.25::DOUBLE))"
    )
    x = "ln(n::DOUBLE)"
    z = f"(ln(1 - w) - {horner(SW_MEAN_LARGE[::-1], x)}) / exp({horner(SW_SD_LARGE[::-1], x)})"
    return f"""{name}_o AS (
  SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY value) AS i,
    count(*) OVER (PARTITION BY variable) AS n FROM {source} WHERE value IS NOT NULL
), {name}_m AS (
  SELECT *, {probit("((i - 0.375::DOUBLE) / (n + 0.25::DOUBLE))")} AS m FROM {name}_o
), {name}_s AS (
  SELECT variable, max(n) AS n, sum(m * m) AS sq, var_pop(value) * count(*) AS spread,
    sum(m * value) - avg(value) * sum(m) AS prod,
    max(value) FILTER (i = n) - max(value) FILTER (i = 1) AS outer_,
    max(value) FILTER (i = n - 1) - max(value) FILTER (i = 2) AS inner_
  FROM {name}_m GROUP BY variable
), {name}_a AS (
  SELECT *, {last} AS m1, {second} AS m2, {horner(SW_LAST[::-1], u)} + {last} / sqrt(sq) AS a1,
    {horner(SW_LAST_BUT_ONE[::-1], u)} + {second} / sqrt(sq) AS a2 FROM {name}_s
), {name}_w AS (
  SELECT variable, n, least(1.0, pow(a1 * outer_ + a2 * inner_ + (prod - m1 * outer_ - m2 * inner_)
    / sqrt((sq - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)), 2) / spread) AS w
  FROM {name}_a
), {name} AS (SELECT variable, n, w, {phi(f"(-({z}))")} AS p FROM {name}_w)"""


SQL["shapiro_wilk"] = with_(METRIC, long(), shapiro_sql("long", "sw")) + f"""
SELECT variable, n, {rounded("w", 7)} AS w, {rounded("p", 7)} AS p, n BETWEEN 3 AND 5000 AS p_valid FROM sw"""

SQL["log1p_effect"] = with_(
    METRIC, long(), "lg AS (SELECT variable, ln(1 + value) AS value FROM long)",
    shapiro_sql("long", "sw"), shapiro_sql("lg", "sl"),
) + f"""
SELECT variable, {rounded("sw.p", 6)} AS p_before, {rounded("sl.p", 6)} AS p_after, sl.p > sw.p AS improved
FROM sw JOIN sl USING (variable)"""

SQL["ks_statistic"] = with_(METRIC, long(), ECDF) + f"SELECT variable, n, {rounded('d', 8)} AS d FROM ks"

# Beyond 10,000 values the limiting series; up to there twice the one-sided tail, right for n d^2 >= 2.2.
KS_P = """far AS (
  SELECT variable, 2 * sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0::DOUBLE * k * k * n * d * d)) AS p
  FROM ks, range(1, 101) AS r(k) GROUP BY variable), near AS (
  SELECT variable, 2 * any_value(d) * sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
    + (j - 1) * ln(d + j / n::DOUBLE) + (n - j) * ln(1 - d - j / n::DOUBLE))) AS p
  FROM ks, range(10001) AS r(j) WHERE n <= 10000 AND j < n * (1 - d) GROUP BY variable), kp AS (
  SELECT ks.*, least(1, greatest(0, CASE WHEN n > 10000 THEN CASE WHEN sqrt(n) * d < 0.2 THEN 1 ELSE far.p END
    ELSE near.p END)) AS p FROM ks JOIN far USING (variable) LEFT JOIN near USING (variable))"""

SQL["ks_normal"] = with_(METRIC, long(), ECDF, KS_P) + (
    f"SELECT variable, n, {rounded('d', 8)} AS d, {rounded('p', 6)} AS p FROM kp"
)

SQL["normality_table"] = with_(METRIC, long(), ECDF, KS_P, shapiro_sql("long", "sw")) + f"""
SELECT variable, {rounded("w", 4)} AS w, {rounded("sw.p", 6)} AS sw_p, {rounded("d", 4)} AS d,
  {rounded("kp.p", 6)} AS ks_p, sw.p > 0.05 AND kp.p > 0.05 AS normal FROM sw JOIN kp USING (variable)"""

SQL["lilliefors"] = with_(METRIC, LOG, _long_both, ECDF) + f""", k AS (
  SELECT *, CASE WHEN n <= 100 THEN d ELSE d * pow(n / 100.0::DOUBLE, 0.49) END AS kd,
    least(n, 100)::DOUBLE AS nd FROM ks), p AS (
  SELECT *, exp(-7.01256 * kd * kd * (nd + 2.78019) + 2.99587 * kd * sqrt(nd + 2.78019) - 0.122119
    + 0.974598 / sqrt(nd) + 1.67997 / nd) AS small,
    (sqrt(n) - 0.01 + 0.85 / sqrt(n)) * d AS kk FROM k)
SELECT variable, n, {rounded("d", 8)} AS d, {rounded('''CASE WHEN small <= 0.1 THEN small
  WHEN kk <= 0.302 THEN 1
  WHEN kk <= 0.5 THEN 2.76773 - 19.828315*kk + 80.709644*kk^2 - 138.55152*kk^3 + 81.218052*kk^4
  WHEN kk <= 0.9 THEN -4.901232 + 40.662806*kk - 97.490286*kk^2 + 94.029866*kk^3 - 32.355711*kk^4
  WHEN kk <= 1.31 THEN 6.198765 - 19.558097*kk + 23.186922*kk^2 - 12.234627*kk^3 + 2.423045*kk^4
  ELSE 0 END''', 8)} AS p FROM p"""

SQL["qq_points"] = with_(LOG) + f""", o AS (
  SELECT churn AS value, row_number() OVER (ORDER BY churn) AS i, count(*) OVER () AS n FROM log
  WHERE churn IS NOT NULL), p AS (
  SELECT i, value, CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n)
    WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n)
    ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM o)
SELECT i, value, {rounded("p", 8)} AS p, {rounded(probit("p"), 8)} AS theoretical FROM p"""

SQL["qq_line"] = with_(LOG) + f""", o AS (
  SELECT churn AS y, (row_number() OVER (ORDER BY churn) - 0.5::DOUBLE) / count(*) OVER () AS p
  FROM log WHERE churn IS NOT NULL), q AS (SELECT y, {probit("p")} AS x FROM o)
SELECT 'churn' AS variable, count(*) AS n, {rounded("regr_slope(y, x)", 6)} AS slope,
  {rounded("regr_intercept(y, x)", 6)} AS intercept, {rounded("regr_r2(y, x)", 6)} AS r2 FROM q"""


def matrix(source: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {rounded(f'corr({a}, {b})', 3)} AS r FROM {source}"
        for a in cols for b in cols
    )


_ranks = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}"
    for c in METRICS
)
COMPLETE = f"complete AS (SELECT * FROM metric WHERE {_incomplete})"

SQL["pearson_matrix"] = with_(METRIC) + matrix("metric", METRICS)
SQL["pearson_matrix_listwise"] = with_(METRIC, COMPLETE) + matrix("complete", METRICS)
SQL["spearman_matrix"] = with_(METRIC, COMPLETE, f"ranks AS (SELECT {_ranks} FROM complete)") + matrix(
    "ranks", METRICS
)


def _pair_ranks(a: str, b: str) -> str:
    def rank(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"

    return (
        f"SELECT '{a}' AS x, '{b}' AS y, {rounded('corr(u, v)', 3)} AS r FROM ("
        f"SELECT {rank(a)} AS u, {rank(b)} AS v FROM metric WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


_three = ["l_quantity", "p_size", "l_linenumber"]
SQL["spearman_matrix_pairwise"] = with_(METRIC) + " UNION ALL ".join(
    _pair_ranks(a, b) for a in _three for b in _three
)

_derived = ["l_quantity", "p_size", "p_retailprice", "both", "mostly"]
SQL["notable_pairs"] = with_(METRIC) + f""", t AS (
  SELECT l_quantity, p_size, p_retailprice, l_quantity + p_size AS "both",
    l_quantity * 3 - p_size AS mostly FROM metric), m AS ({
    matrix("t", _derived).replace("(both", '("both"').replace(" both)", ' "both")').replace(", both", ', "both"')
  })
SELECT x, y, r, CASE WHEN abs(r) >= 0.7 THEN 'strong' ELSE 'moderate' END AS strength
FROM m WHERE x < y AND abs(r) >= 0.4"""

PAIRS = [("l_quantity", "l_extendedprice"), ("p_size", "l_linenumber"), ("l_tax", "p_retailprice")]
SQL["pair_lines"] = with_(METRIC) + " UNION ALL ".join(
    f"""SELECT '{a}' AS x, '{b}' AS y, regr_count({b}, {a})::BIGINT AS n, {rounded(f"corr({a}, {b})", 3)} AS r,
  CASE WHEN abs(corr({a}, {b})) >= 0.8 THEN '***' WHEN abs(corr({a}, {b})) >= 0.5 THEN '**'
       WHEN abs(corr({a}, {b})) >= 0.3 THEN '*' ELSE '' END AS stars_by_size,
  {rounded(f"regr_slope({b}, {a})", 6)} AS slope, {rounded(f"regr_intercept({b}, {a})", 4)} AS intercept,
  {rounded(f"sqrt(regr_syy({b}, {a}) * (1 - corr({a}, {b}) ^ 2) / (regr_count({b}, {a}) - 2))", 4)} AS residual_se,
  {rounded(f"regr_avgx({b}, {a})", 4)} AS x_mean FROM metric"""
    for a, b in PAIRS
)


# --- statistical models -----------------------------------------------------------------

SQL["ols_one_predictor"] = with_(METRIC) + f""", f AS (
  SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_count(y, x) AS n, regr_sxx(y, x) AS sxx,
    sqrt(regr_syy(y, x) * (1 - regr_r2(y, x)) / (regr_count(y, x) - 2)) AS s, regr_avgx(y, x) AS mx
  FROM (SELECT l_extendedprice AS y, p_retailprice AS x FROM metric)), e AS (
  SELECT *, s / sqrt(sxx) AS sb, s * sqrt(1.0 / n + mx * mx / sxx) AS sa FROM f)
SELECT 'p_retailprice' AS term, {rounded("b", 4)} AS coefficient, {rounded("sb", 4)} AS std_error,
  {rounded("b / sb", 4)} AS t FROM e UNION ALL
SELECT 'const', {rounded("a", 4)}, {rounded("sa", 4)}, {rounded("a / sa", 4)} FROM e"""

SQL["ols_fit_quality"] = with_(METRIC) + f""", f AS (
  SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2, count(*) AS n
  FROM (SELECT l_extendedprice AS y, p_retailprice AS x FROM metric))
SELECT 'model' AS model, any_value(n) AS n, {rounded("any_value(r2)", 4)} AS r2,
  {rounded("1 - (1 - any_value(r2)) * (any_value(n) - 1) / (any_value(n) - 2)", 4)} AS r2_adj,
  {rounded("sqrt(avg((l_extendedprice - a - b * p_retailprice) ^ 2))", 4)} AS rmse,
  {rounded("avg(abs(l_extendedprice - a - b * p_retailprice))", 4)} AS mae FROM metric, f"""

SQL["vif"] = with_(METRIC) + f""", r AS (
  SELECT corr(l_quantity, p_retailprice) AS ab, corr(l_quantity, l_linenumber) AS ac,
    corr(p_retailprice, l_linenumber) AS bc FROM metric WHERE l_linenumber IS NOT NULL), det AS (
  SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS d FROM r)
SELECT 'l_quantity' AS variable, {rounded("(1 - bc * bc) / d", 6)} AS vif FROM det UNION ALL
SELECT 'p_retailprice', {rounded("(1 - ac * ac) / d", 6)} FROM det UNION ALL
SELECT 'l_linenumber', {rounded("(1 - ab * ab) / d", 6)} FROM det"""

PREDICTORS = ["l_quantity", "p_retailprice", "l_linenumber"]
#: The constant and the predictors, from their means.
_TERMS = range(len(PREDICTORS) + 1)


def _rows_of(y: str) -> str:
    """``d``: y and the centred predictors x1, x2, ... of the complete rows; ``m``: means and number."""
    xs = list(enumerate(PREDICTORS, 1))
    complete = " AND ".join(f"{x} IS NOT NULL" for x in PREDICTORS)
    return f""", m AS MATERIALIZED (
  SELECT count(*) AS n, {", ".join(f"avg({x}) AS m{i}" for i, x in xs)} FROM metric WHERE {complete}), d AS MATERIALIZED (
  SELECT {y} AS y, 1.0::DOUBLE AS x0, {", ".join(f"{x} - m{i} AS x{i}" for i, x in xs)} FROM metric, m WHERE {complete})"""


def _solved(name: str, rows: str, weight: str, right: str) -> str:
    """``name``: the solution a_i_k of the weighted normal equations, k the number of terms, with their inverse behind.

    Gauss and Jordan: each step clears one column of the matrix, the right side and the identity.
    """
    k = len(_TERMS)
    start = [f"sum({weight} * x{i} * x{j}) AS a_{i}_{j}" for i in _TERMS for j in _TERMS]
    start += [f"sum(x{i} * {right}) AS a_{i}_{k}" for i in _TERMS]
    start += [f"{float(i == j)}::DOUBLE AS a_{i}_{k + 1 + j}" for i in _TERMS for j in _TERMS]
    sql = f", {name}_0 AS MATERIALIZED (SELECT {', '.join(start)} FROM {rows})"
    for p in _TERMS:
        cells = []
        for c in range(p + 1, 2 * k + 1):
            pivot = f"a_{p}_{c} / a_{p}_{p}"
            cells += [f"{pivot if i == p else f'a_{i}_{c} - a_{i}_{p} * {pivot}'} AS a_{i}_{c}" for i in _TERMS]
        into = name if p == k - 1 else f"{name}_{p + 1}"
        sql += f", {into} AS MATERIALIZED (SELECT {', '.join(cells)} FROM {name}_{p})"
    return sql


def _inverse(i: int, j: int) -> str:
    return f"a_{i}_{len(_TERMS) + 1 + j}"


def _estimates(coefficient, variance: str) -> str:
    """Rows (term, b, e): ``e`` the root of the variance factor times the inverse's diagonal, for uncentred terms."""
    shift = ["1", *[f"(-m{i})" for i in _TERMS[1:]]]
    spread = " + ".join(f"{shift[i]} * {shift[j]} * {_inverse(i, j)}" for i in _TERMS for j in _TERMS)
    const = " + ".join(f"{shift[i]} * {coefficient(i)}" for i in _TERMS)
    rows = [(x, coefficient(i), _inverse(i, i)) for i, x in enumerate(PREDICTORS, 1)] + [("const", const, spread)]
    return " UNION ALL ".join(
        f"SELECT '{term}' AS term, {b} AS b, sqrt({variance} * ({v})) AS e FROM final" for term, b, v in rows
    )


def _line(i: int) -> str:
    return f"a_{i}_{len(_TERMS)}"


_FITTED = " + ".join(f"{_line(i)} * x{i}" for i in _TERMS)
_OLS = with_(METRIC) + _rows_of("l_extendedprice") + _solved("s", "d", "1", "y")

# The two-sided p of t integrates the density by Simpson's rule.
SQL["ols_summary"] = _OLS + f""", final AS (
  SELECT *, n - {len(_TERMS)} AS v, (SELECT sum((y - ({_FITTED})) ^ 2) FROM d, s) AS rss FROM s, m), e AS (
  {_estimates(_line, "rss / v")}), t AS (
  SELECT term, b, e, b / e AS t, least(abs(b / e), 40) / 4000 AS w, (SELECT v FROM final) AS v FROM e), f AS (
  SELECT term, any_value(b) AS b, any_value(e) AS e, any_value(t) AS t, any_value(w) / 3
    * exp(lgamma((any_value(v) + 1) / 2) - lgamma(any_value(v) / 2)) / sqrt(any_value(v) * pi())
    * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(1 + (i * w) ^ 2 / v, -(v + 1) / 2)) AS half
  FROM t, range(4001) AS r(i) GROUP BY term)
SELECT term, {rounded("b", 4)} AS coefficient, {rounded("e", 4)} AS std_error, {rounded("t", 4)} AS t,
  {rounded("greatest(1 - 2 * half, 0)", 6)} AS p FROM f"""

SQL["vif_with_constant"] = _OLS + f""", final AS (
  SELECT *, {", ".join(f"(SELECT sum(x{i} ^ 2) FROM d) AS q{i}" for i in _TERMS[1:])}, n AS q0 FROM s, m), e AS (
  {_estimates(_line, "1")})
SELECT term AS variable, {rounded("e * e * CASE term " + " ".join(
    f"WHEN '{x}' THEN q{i}" for i, x in enumerate([*PREDICTORS, "const"], 1) if x != "const"
  ) + " ELSE q0 END", 6)} AS vif FROM e, (SELECT q0, q1, q2, q3 FROM final)"""

_RESIDUALS = _OLS + f""", long AS (
  SELECT 'residual' AS variable, y - ({_FITTED}) AS value FROM d, s)"""
SQL["residual_histogram"] = f"""SELECT * REPLACE ({rounded("left_edge", 3)} AS left_edge) FROM (
{_RESIDUALS}{histogram_sql(40)})"""

SQL["residual_qq"] = _RESIDUALS + f""", o AS (
  SELECT value AS y, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM long), p AS (
  SELECT y, CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n)
    WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n)
    ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM o), q AS (SELECT y, {probit("p")} AS x FROM p)
SELECT 'residual' AS variable, count(*) AS n, {rounded("regr_slope(y, x)", 4)} AS slope,
  {rounded("regr_intercept(y, x)", 4)} AS intercept, {rounded("regr_r2(y, x)", 4)} AS r2 FROM q"""

_LOGIT_STEPS = 12
_eta = " + ".join(f"b{i} * x{i}" for i in _TERMS)
_newton = ", b_0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in _TERMS) + ")"
for _step in range(_LOGIT_STEPS):
    _newton += f""", p_{_step} AS (
  SELECT d.*, 1 / (1 + exp(-({_eta}))) AS p FROM d, b_{_step})"""
    _newton += _solved(f"s_{_step}", f"p_{_step}", "p * (1 - p)", "(y - p)")
    _newton += f""", b_{_step + 1} AS MATERIALIZED (
  SELECT {", ".join(f"b{i} + {_line(i)} AS b{i}" for i in _TERMS)} FROM b_{_step}, s_{_step})"""
_LOGIT = (
    with_(METRIC) + _rows_of("(l_extendedprice > 53000)::INT") + _newton
    + f", final AS (SELECT * FROM b_{_LOGIT_STEPS}, s_{_LOGIT_STEPS - 1}, m), e AS ("
    + _estimates(lambda i: f"b{i}", "1") + "), z AS (SELECT *, -abs(b / e) AS z FROM e)"
)
SQL["logit_summary"] = _LOGIT + f"""
SELECT term, {rounded("b", 6)} AS coefficient, {rounded("e", 6)} AS std_error, {rounded("b / e", 6)} AS z,
  {rounded(f"2 * ({phi('z')})", 6)} AS p, 'converged' AS state FROM z"""
SQL["odds_ratios"] = _LOGIT + f"""
SELECT term, {rounded("b", 4)} AS coefficient, {rounded("exp(b)", 4)} AS odds_ratio,
  {rounded(f"2 * ({phi('z')})", 4)} AS p FROM z"""

SQL["nested_models"] = with_(METRIC) + f""", r AS (
  SELECT corr(l_extendedprice, l_quantity) AS y1, corr(l_extendedprice, p_retailprice) AS y2,
    corr(l_quantity, p_retailprice) AS ab, count(*) AS n FROM metric), q AS (
  SELECT 'base' AS model, n, y1 * y1 AS r2, 1 AS k FROM r UNION ALL
  SELECT 'extended', n, (y1 * y1 + y2 * y2 - 2 * y1 * y2 * ab) / (1 - ab * ab), 2 FROM r)
SELECT model, n, {rounded("r2", 4)} AS r2, {rounded("1 - (1 - r2) * (n - 1) / (n - k - 1)", 4)} AS r2_adj
FROM q"""

SQL["residual_diagnostics"] = with_(METRIC) + f""", f AS (
  SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
  FROM metric)
SELECT id, l_partkey, l_extendedprice AS actual, {rounded("a + b * l_quantity", 3)} AS fitted,
  {rounded("l_extendedprice - a - b * l_quantity", 3)} AS residual FROM metric, f"""

SQL["ridge_one_predictor"] = with_(METRIC, COMPLETE) + f""", m AS (
  SELECT avg(p_retailprice) AS mx, stddev_pop(p_retailprice) AS sx, avg(l_extendedprice) AS my,
    count(*) AS n FROM metric), w AS (
  SELECT any_value(mx) AS mx, any_value(sx) AS sx, any_value(my) AS my,
    sum((p_retailprice - mx) / sx * (l_extendedprice - my)) / (any_value(n) + 1000.0) AS b FROM metric, m)
SELECT id, l_partkey, {rounded("my + b * (p_retailprice - mx) / sx", 2)} AS estimate FROM metric, w"""

SQL["class_weights"] = with_(SCORED) + f""", c AS (
  SELECT label, count(*) AS n FROM scored GROUP BY label), t AS (
  SELECT sum(n) AS n_all, count(*) AS k, sum(n) FILTER (WHERE label = 0) AS neg,
    sum(n) FILTER (WHERE label = 1) AS pos FROM c)
SELECT label, n, {rounded("n_all / (k * n)::DOUBLE", 6)} AS balanced_weight,
  {rounded("neg / greatest(pos, 1)::DOUBLE", 6)} AS pos_ratio FROM c, t"""


# --- splits and evaluation --------------------------------------------------------------

SQL["temporal_split"] = """
SELECT o_orderkey, datediff('day', DATE '1970-01-01', o_orderdate::DATE)::INT AS "day",
  CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(0.75 * count(*) OVER ())
       THEN 'train' ELSE 'test' END AS split FROM orders"""

HASHED = """hashed AS (
  SELECT *, ('0x' || substr(md5('42|' || id), 1, 15))::BIGINT AS h FROM scored)"""
SQL["stratified_split"] = with_(SCORED, HASHED) + """
SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY h, id)
  <= ceil(0.25 * count(*) OVER (PARTITION BY label)) AS is_test FROM hashed"""
SQL["random_split"] = with_(SCORED, HASHED) + """
SELECT id, row_number() OVER (ORDER BY h, id) <= ceil(0.25 * count(*) OVER ()) AS is_test FROM hashed"""
SQL["stratified_folds"] = with_(SCORED, HASHED) + """
SELECT id, label, ((row_number() OVER (PARTITION BY label ORDER BY h, id) - 1) % 5)::INT AS fold FROM hashed"""

PREDICTED = "predicted AS (SELECT *, (score >= 0.1)::INT AS prediction FROM scored)"
SQL["confusion_matrix"] = with_(SCORED, PREDICTED) + """
SELECT a.v AS actual, p.v AS predicted, (SELECT count(*) FROM predicted
  WHERE label = a.v AND prediction = p.v) AS n
FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) p(v)"""

CELLS = """cells AS (
  SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn,
    count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
    count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp FROM predicted)"""
_report = {
    "0": ("tn/(tn+fn)", "tn/(tn+fp)", "2*tn/(2*tn+fn+fp)", "tn+fp"),
    "1": ("tp/(tp+fp)", "tp/(tp+fn)", "2*tp/(2*tp+fp+fn)", "tp+fn"),
}
_all = "(tn+fp+fn+tp)"
_report["accuracy"] = (f"(tp+tn)/{_all}",) * 3 + (_all,)
_report["macro avg"] = tuple(
    f"({a} + {b}) / 2" for a, b in zip(_report["0"][:3], _report["1"][:3])
) + (_all,)
_report["weighted avg"] = tuple(
    f"(({a}) * (tn+fp) + ({b}) * (tp+fn)) / {_all}" for a, b in zip(_report["0"][:3], _report["1"][:3])
) + (_all,)
SQL["classification_report"] = with_(SCORED, PREDICTED, CELLS) + " UNION ALL ".join(
    f"""SELECT '{k}' AS "row", {rounded(v[0], 4)} AS "precision", {rounded(v[1], 4)} AS recall,
  {rounded(v[2], 4)} AS f1, ({v[3]})::BIGINT AS support FROM cells"""
    for k, v in _report.items()
)

CURVE = """groups AS (
  SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM scored GROUP BY score), curve AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM groups)"""
_auc = "sum(neg * (tp - pos + pos / 2.0::DOUBLE)) / (any_value(p) * any_value(n))::DOUBLE"
_ap = "sum(pos * (tp::DOUBLE / (tp + fp))) / any_value(p)"
SQL["roc_curve"] = with_(SCORED, CURVE) + f"""
SELECT score AS threshold, {rounded("fp::DOUBLE / n", 9)} AS fpr, {rounded("tp::DOUBLE / p", 9)} AS tpr FROM curve"""
SQL["pr_curve"] = with_(SCORED, CURVE) + f"""
SELECT score AS threshold, {rounded("tp::DOUBLE / (tp + fp)", 9)} AS "precision",
  {rounded("tp::DOUBLE / p", 9)} AS recall FROM curve"""
SQL["roc_auc"] = with_(SCORED, CURVE) + f"SELECT {rounded(_auc, 6)} AS roc_auc FROM curve"
SQL["average_precision"] = with_(SCORED, CURVE) + f"SELECT {rounded(_ap, 6)} AS average_precision FROM curve"

_metric_list = {
    "accuracy": "(tp+tn)/(tn+fp+fn+tp)",
    "precision": "coalesce(tp/nullif(tp+fp,0), 0)",
    "recall": "coalesce(tp/nullif(tp+fn,0), 0)",
    "f1": "coalesce(2*tp/nullif(2*tp+fp+fn,0), 0)",
}
_metric_text = ", ".join(f'{rounded(v, 4)} AS "{k}"' for k, v in _metric_list.items())
SQL["classifier_metrics"] = with_(SCORED, PREDICTED, CELLS, CURVE) + f"""
SELECT {_metric_text}, (SELECT {rounded(_auc, 4)} FROM curve) AS roc_auc,
  (SELECT {rounded(_ap, 4)} FROM curve) AS pr_auc FROM cells"""

SQL["regression_metrics"] = with_(METRIC) + f"""
SELECT l_returnflag, {rounded("sqrt(avg((l_quantity - p_size) ^ 2))", 4)} AS rmse,
  {rounded("avg(abs(l_quantity - p_size))", 4)} AS mae FROM metric GROUP BY l_returnflag"""


def by_model(source: str, name: str) -> str:
    """Cells and F1 of the three threshold scorers on one set of rows."""
    return f"""{name} AS (
  SELECT model, {", ".join(f'{v} AS "{k}"' for k, v in _metric_list.items())} FROM (
    SELECT model, count(*) FILTER (WHERE label = 0 AND NOT hit)::DOUBLE AS tn,
      count(*) FILTER (WHERE label = 0 AND hit)::DOUBLE AS fp,
      count(*) FILTER (WHERE label = 1 AND NOT hit)::DOUBLE AS fn,
      count(*) FILTER (WHERE label = 1 AND hit)::DOUBLE AS tp
    FROM (SELECT label, model, score >= bound AS hit FROM {source},
      (VALUES ('low', 0.01::DOUBLE), ('mid', 0.05::DOUBLE), ('high', 0.2::DOUBLE)) b(model, bound))
    GROUP BY model))"""


SQL["classifier_metrics_by_model"] = with_(SCORED, CURVE, by_model("scored", "bm")) + f"""
SELECT model, {", ".join(f'{rounded(chr(34) + k + chr(34), 4)} AS "{k}"' for k in _metric_list)},
  (SELECT {rounded(_auc, 4)} FROM curve) AS roc_auc, (SELECT {rounded(_ap, 4)} FROM curve) AS pr_auc
FROM bm"""

SQL["leakage_gap"] = with_(
    SCORED, HASHED,
    """late AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY date, id) AS rn,
      count(*) OVER () AS n FROM scored) WHERE rn > floor(0.75 * n))""",
    """mixed AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY h, id) AS rn,
      count(*) OVER () AS n FROM hashed) WHERE rn <= ceil(0.25 * n))""",
    by_model("late", "tm"), by_model("mixed", "rm"),
) + f""", r AS (
  SELECT tm.model, {rounded("tm.f1", 4)} AS temporal, {rounded("rm.f1", 4)} AS random
  FROM tm JOIN rm USING (model))
SELECT model, temporal, random, {rounded("(random - temporal) * 100 / random", 2)} AS gap_pct FROM r"""


# --- streams ----------------------------------------------------------------------------

SQL["stream_ingest"] = "SELECT DISTINCT event_id // 2 AS hash FROM events"
SQL["stream_history"] = with_(LOG) + """
SELECT repo, author, hash, row_number() OVER (PARTITION BY repo, author ORDER BY hash) - 1 AS "EXP" FROM log"""
