"""DuckDB statements that state, independently, what the registered queries must return."""

from casewatch.plans.registry import BATCH_BUCKETS, FIXED_WEIGHTS
from casewatch.sources.bindings import REACTION_RULES, TOXIC_WORDS, TRACKED


def rnd(x, digits):
    scale = f"1e{digits}"
    return f"(CASE WHEN round_even(({x})*{scale},0)=0 THEN 0.0 ELSE round_even(({x})*{scale},0)/{scale} END)"


def _strip(value):
    return f"regexp_replace({value}, '^[\\s\\v]+|[\\s\\v]+$', '', 'g')"


def _ladder(value):
    return (
        "(SELECT CASE WHEN contains(v, 'fatal') OR contains(v, 'death') THEN 'fatal' "
        "WHEN contains(v, 'life-threatening') OR contains(v, 'life threatening') THEN 'life-threatening' "
        "WHEN contains(v, 'hospitalization') OR contains(v, 'disabling') OR contains(v, 'severe') THEN 'severe' "
        "WHEN contains(v, 'non-serious') OR contains(v, 'non serious') THEN 'mild' "
        "WHEN contains(v, 'serious') THEN 'moderate' WHEN contains(v, 'mild') THEN 'mild' ELSE 'moderate' END "
        f"FROM (SELECT lower({_strip(value)}) AS v))"
    )


def _organ(value):
    """Name with most keyword hits, the earlier rule on ties."""
    scored = ", ".join(
        "{'h': "
        + "+".join(f"contains(lower({value}),'{w}')::INT" for w in words)
        + f", 'o': {-i}, 'n': '{name}'}}"
        for i, (name, words) in enumerate(REACTION_RULES.items())
    )
    best = f"list_max([{scored}])"
    return f"(CASE WHEN ({best}).h > 0 THEN ({best}).n ELSE 'other/unclassified' END)"


def _toxic(value):
    return "(" + " OR ".join(f"contains(lower({value}),'{w}')" for w in TOXIC_WORDS) + ")"


_DRUG_POSITION = "CASE drug " + " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(TRACKED)) + " END"
_W7 = "(PARTITION BY drug ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_W30 = "(PARTITION BY drug ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
_A, _B, _G = FIXED_WEIGHTS
_SEVERITY_RAW = (
    "CASE WHEN serious='1' THEN chr(9) || 'Hospitalization ' || chr(10) ELSE CASE drug WHEN 'ECONOMY' THEN 'NON-SERIOUS' "
    "WHEN 'LARGE' THEN ' unknown ' WHEN 'MEDIUM' THEN 'non-serious/other' WHEN 'PROMO' THEN 'Severe' "
    "WHEN 'SMALL' THEN 'odd' ELSE 'mild' END END"
)


def _lookup(value):
    v = f"lower({_strip(value)})"
    return (
        f"(CASE {v} WHEN 'hospitalization' THEN 'severe' WHEN 'non-serious' THEN 'mild' "
        f"WHEN 'non-serious/other' THEN 'mild' WHEN 'unknown' THEN 'moderate' ELSE {v} END)"
    )


# Common table expressions, each after the ones it uses.
CTES = {
    "mentions": """
        SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS safetyreportid, p_type AS drug,
               CAST(o_orderdate AS DATE) AS date,
               CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN '1' ELSE '2' END AS serious
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "daily": """
        SELECT drug, date, count(DISTINCT safetyreportid) AS cnt FROM mentions
        WHERE serious = '1' GROUP BY drug, date""",
    "events_daily": """
        SELECT event_type AS drug, CAST(ts AS DATE) AS date, count(*) AS cnt FROM events GROUP BY 1, 2""",
    "filled": """
        SELECT s.drug, s.date, coalesce(d.cnt, 0) AS cnt,
               row_number() OVER (PARTITION BY s.drug ORDER BY s.date) - 1 AS pos
        FROM (SELECT drug, CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date
              FROM (SELECT drug, CAST(min(date) AS TIMESTAMP) AS lo, CAST(max(date) AS TIMESTAMP) AS hi
                    FROM daily GROUP BY drug)) s
        LEFT JOIN daily d ON d.drug = s.drug AND d.date = s.date""",
    "scored": f"""
        SELECT *, CASE WHEN count(*) OVER {_W30} >= 7 THEN coalesce((raw_residual - avg(raw_residual) OVER {_W30})
                 / nullif(stddev_samp(raw_residual) OVER {_W30}, 0), 0) ELSE 0 END AS raw_z
        FROM (SELECT *, cnt - expected AS raw_residual
              FROM (SELECT *, avg(cnt) OVER {_W7} AS expected FROM filled))""",
    "pub": f"""
        SELECT drug, date, cnt AS count, {rnd('expected', 2)} AS expected_count,
               {rnd('cnt - ' + rnd('expected', 2), 2)} AS residual, {rnd('raw_z', 2)} AS zscore,
               pos >= 45 AND abs(raw_z) > 2.5 AS is_anomaly_zscore
        FROM scored""",
    "flagged": "SELECT * FROM pub WHERE is_anomaly_zscore",
    "lists": """
        SELECT l_orderkey,
               list_sort(list(DISTINCT p_type || ' ' || p_brand)) AS products,
               list_filter(list_sort(list(DISTINCT CASE WHEN p_size <= 2 THEN '' ELSE p_name END)),
                           lambda x: x <> '') AS names
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "reports": """
        SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, strftime(o_orderdate, '%Y%m%d') AS receivedate,
               CAST(o_orderdate AS DATE) AS received,
               CASE o_custkey % 4 WHEN 1 THEN 'male' WHEN 2 THEN 'female' ELSE 'unknown' END AS sex,
               CASE WHEN o_custkey % 4 <> 0 THEN 'x' END AS sex_given,
               CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey % 90 + 1 AS VARCHAR) END AS age,
               products, names, o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' AS disabling,
               list_filter([
                   CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'death' END,
                   CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'hospitalization' END,
                   CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'life-threatening' END,
                   CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN 'disabling' END],
                   lambda x: x IS NOT NULL) AS flags
        FROM orders JOIN lists ON l_orderkey = o_orderkey""",
    "flat": """
        SELECT r.safetyreportid, m.drug, receivedate, received, sex AS patient_sex, age AS patient_age,
               array_to_string(names, '; ') AS reactions, array_to_string(products, '; ') AS drugs_involved,
               array_to_string(flags, '; ') AS seriousness_flags, products, names,
               'A ' || coalesce(age, 'unknown-age') || ' year old ' || sex || ' patient taking '
               || array_to_string(products, ', ') || ' experienced: '
               || CASE WHEN len(names) = 0 THEN 'unspecified reaction(s)' ELSE array_to_string(names, ', ') END
               || '. Seriousness: '
               || CASE WHEN len(flags) = 0 THEN 'non-serious/other' ELSE array_to_string(flags, ', ') END
               || '. Report received ' || receivedate || '.' AS patient_summary_text
        FROM reports r JOIN mentions m ON m.safetyreportid = r.safetyreportid""",
    "summaries": f"""
        SELECT * FROM flat
        QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY {_DRUG_POSITION}) = 1""",
    "categorized": f"""
        SELECT *, {_organ('reactions')} AS primary_organ_system,
               {_ladder("regexp_extract(patient_summary_text, 'Seriousness: ([^.]*)[.]', 1)")} AS severity
        FROM summaries""",
    "first_labels": f"""
        SELECT safetyreportid, lower(drug) AS primary_organ_system, {_SEVERITY_RAW} AS severity_before,
               {_lookup(_SEVERITY_RAW)} AS severity
        FROM mentions QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY drug) = 1""",
    "numbered": f"""
        SELECT *, CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY safetyreportid) - 1) / 20) AS INT)
                  AS batch
        FROM (SELECT safetyreportid, patient_summary_text,
                     CAST(CAST('0x' || substr(sha256(safetyreportid), 1, 8) AS BIGINT)
                          % {BATCH_BUCKETS} AS INT) AS bucket
              FROM summaries)""",
    "batches": """
        SELECT bucket, batch, count(*) AS n_items,
               substr(sha256('["' || string_agg(safetyreportid, '", "' ORDER BY safetyreportid) || '"]'), 1, 24)
                   AS batch_id,
               sha256('[' || string_agg('{"id":"' || safetyreportid || '","patient_summary_text":"'
                      || patient_summary_text || '"}', ',' ORDER BY safetyreportid) || ']') AS request_digest
        FROM numbered GROUP BY bucket, batch""",
    "near": """
        SELECT f.drug, f.date, f.count, f.expected_count, f.zscore, m.safetyreportid, m.date AS received,
               abs(date_diff('day', f.date, m.date)) AS distance
        FROM flagged f JOIN mentions m
          ON m.drug = f.drug AND m.date BETWEEN f.date - INTERVAL 3 DAY AND f.date + INTERVAL 3 DAY""",
    "top8": """
        SELECT *, row_number() OVER (PARTITION BY drug, date ORDER BY distance, safetyreportid) AS position
        FROM near QUALIFY position <= 8""",
    "ctx": f"""
        SELECT t.*, f.patient_summary_text, f.names, {_organ('f.reactions')} AS organ,
               {_ladder("regexp_extract(f.patient_summary_text, 'Seriousness: ([^.]*)[.]', 1)")} AS severity
        FROM top8 t JOIN flat f ON f.safetyreportid = t.safetyreportid AND f.drug = t.drug""",
    "bundle": """
        SELECT drug, date, count(*) AS n_context_reports,
               string_agg(position || '. ' || patient_summary_text, chr(10) ORDER BY position) AS context,
               string_agg(patient_summary_text, ' ' ORDER BY position) AS sources
        FROM ctx GROUP BY drug, date""",
    "top_organ": """
        SELECT drug, date, organ FROM ctx GROUP BY drug, date, organ
        QUALIFY row_number() OVER (PARTITION BY drug, date ORDER BY count(*) DESC, organ) = 1""",
    "top_severity": """
        SELECT drug, date, severity FROM ctx GROUP BY drug, date, severity
        QUALIFY row_number() OVER (PARTITION BY drug, date ORDER BY count(*) DESC, severity) = 1""",
    "top_reaction": """
        SELECT drug, date, r, count(*) AS n FROM (SELECT drug, date, unnest(names) AS r FROM ctx)
        GROUP BY drug, date, r
        QUALIFY row_number() OVER (PARTITION BY drug, date ORDER BY count(*) DESC, r) = 1""",
    "explained": """
        SELECT f.drug, f.date, f.count, f.expected_count, f.zscore, b.n_context_reports,
               CASE WHEN f.zscore >= 0 THEN 'SPIKE (higher than expected)' ELSE 'DROP (lower than expected)' END
                 || ': ' || f.count || ' reports for ' || f.drug || ' on ' || f.date || '.' AS summary,
               o.organ AS dominant_organ_systems, s.severity AS dominant_severity,
               CASE WHEN r.n >= 2 THEN 'most frequent reaction: ' || r.r || ', ' || r.n || ' mentions'
                    ELSE 'no reaction stands out in the reports nearby' END AS notable_pattern,
               'Drawn from a few nearby reports: a hint where to look, not a medical finding.'
                 AS confidence_caveat
        FROM flagged f JOIN bundle b USING (drug, date) JOIN top_organ o USING (drug, date)
        JOIN top_severity s USING (drug, date) LEFT JOIN top_reaction r USING (drug, date)""",
    "claims": """
        SELECT drug, date, 'Organ systems affected: [''' || dominant_organ_systems || ''']. Severity: '
               || dominant_severity || '. Notable pattern: ' || notable_pattern AS claim
        FROM explained""",
    "terms": """
        SELECT c.drug, c.date,
               list_filter(list_distinct(string_split_regex(lower(claim), '[^a-z0-9]+')), lambda x: x <> '') AS wanted,
               string_split_regex(lower(sources), '[^a-z0-9]+') AS have
        FROM claims c JOIN bundle b USING (drug, date)""",
    "scores": """
        SELECT drug, date, len(list_filter(wanted, lambda x: list_contains(have, x))) / len(wanted) AS score
        FROM terms""",
    "collected": """
        SELECT drug, date, count, zscore,
               CASE WHEN zscore >= 3.5 THEN 'Hospitalization and death' WHEN zscore >= 3 THEN ' Life threatening'
                    WHEN zscore >= 2.7 THEN 'non-serious/other and hospitalization'
                    WHEN zscore > 0 THEN 'Non-Serious/other' END AS severity_before,
               CASE WHEN zscore >= 3.5 THEN 'fatal' WHEN zscore >= 3 THEN 'life-threatening'
                    WHEN zscore >= 2.7 THEN 'severe' WHEN zscore > 0 THEN 'mild' ELSE 'moderate' END
                    AS dominant_severity,
               'skin|' || lower(drug) AS dominant_organ_systems
        FROM flagged""",
    "template": f"""
        SELECT CAST(d.doc_id AS VARCHAR) AS safetyreportid, source AS drug, text,
               CASE WHEN n_chars >= 500 THEN 'High ' ELSE ' low' END AS predicted_organ_system,
               CASE WHEN {_toxic('text')} THEN 'Severe' ELSE 'mild' END AS predicted_severity,
               CASE quality WHEN 1 THEN ' high' WHEN 0 THEN 'LOW' ELSE '' END AS true_organ_system,
               CASE WHEN quality = 1 AND toxic = 1 THEN 'severe' WHEN quality = 1 AND toxic = 0 THEN 'mild'
                    ELSE ' ' END AS true_severity
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "judged": """
        SELECT *, lower(trim(true_organ_system)) = lower(trim(predicted_organ_system)) AS organ_ok,
               lower(trim(true_severity)) = lower(trim(predicted_severity)) AS severity_ok,
               trim(true_severity) <> '' AS has_severity
        FROM template WHERE trim(true_organ_system) <> ''""",
    "accuracy": """
        SELECT count(*) AS n_labelled, avg(organ_ok::INT) AS organ_accuracy,
               avg(severity_ok::INT) FILTER (WHERE has_severity) AS severity_accuracy,
               count(*) FILTER (WHERE NOT organ_ok) AS n_mismatches
        FROM judged""",
    "mismatches": """
        SELECT safetyreportid, predicted_organ_system, true_organ_system FROM judged WHERE NOT organ_ok
        ORDER BY safetyreportid LIMIT 20""",
    "vecs": """
        SELECT vec_id, CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS v,
               CAST(label AS VARCHAR) AS label
        FROM embeddings""",
    "args": "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS query, v AS q FROM vecs ORDER BY vec_id LIMIT 5",
    "sims": """
        SELECT query, id, label, round_even(list_dot_product(v, q)
               / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(q, q))) * 1e12, 0) / 1e12 AS s
        FROM vecs CROSS JOIN args""",
    "normals": """
        SELECT t, j, list(v ORDER BY d) AS p
        FROM (SELECT t, j, d, ('0x' || substring(md5('42/' || t || '/' || j || '/' || d), 1, 8))::BIGINT / 2147483648::DOUBLE - 1 AS v
              FROM (SELECT unnest(range(8)) AS t), (SELECT unnest(range(6)) AS j), (SELECT unnest(range(64)) AS d))
        GROUP BY t, j""",
    "codes": """
        SELECT id, t, CAST(sum(CASE WHEN list_dot_product(v, p) > 0 THEN 1 << j ELSE 0 END) AS BIGINT) AS code
        FROM vecs CROSS JOIN normals GROUP BY id, t""",
    "probes": """
        SELECT query, t, xor(home, turned) AS code
        FROM (SELECT query, t, turned, CAST(sum(CASE WHEN m > 0 THEN 1 << j ELSE 0 END) AS BIGINT) AS home,
                     round(sum(CASE WHEN (turned >> j) & 1 = 1 THEN m * m ELSE 0 END), 9) AS cost
              FROM (SELECT query, t, j, list_dot_product(q, p) AS m FROM args CROSS JOIN normals),
                   (SELECT unnest(range(64)) AS turned)
              GROUP BY query, t, turned)
        QUALIFY row_number() OVER (PARTITION BY query, t ORDER BY cost, turned) <= 12""",
    "candidates": "SELECT DISTINCT query, id FROM probes JOIN codes USING (t, code)",
}

# Direct uses between the expressions above.
USES = {
    "daily": ["mentions"],
    "filled": ["daily"],
    "scored": ["filled"],
    "pub": ["scored"],
    "flagged": ["pub"],
    "reports": ["lists"],
    "flat": ["reports", "mentions"],
    "summaries": ["flat"],
    "categorized": ["summaries"],
    "first_labels": ["mentions"],
    "numbered": ["summaries"],
    "batches": ["numbered"],
    "near": ["flagged", "mentions"],
    "top8": ["near"],
    "ctx": ["top8", "flat"],
    "bundle": ["ctx"],
    "top_organ": ["ctx"],
    "top_severity": ["ctx"],
    "top_reaction": ["ctx"],
    "explained": ["flagged", "bundle", "top_organ", "top_severity", "top_reaction"],
    "claims": ["explained"],
    "terms": ["claims", "bundle"],
    "scores": ["terms"],
    "collected": ["flagged"],
    "judged": ["template"],
    "accuracy": ["judged"],
    "mismatches": ["judged"],
    "args": ["vecs"],
    "sims": ["vecs", "args"],
    "codes": ["vecs", "normals"],
    "probes": ["args", "normals"],
    "candidates": ["probes", "codes"],
}


def _needed(names):
    out = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in out:
            out.add(name)
            todo += USES.get(name, [])
    return [n for n in CTES if n in out]


def _sql(select, *names, recursive=None):
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in _needed(names)]
    if recursive:
        parts.append(recursive)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" + select) if parts else select


_DAY = "CAST(date AS VARCHAR) AS date"
_HW = f"""
start AS (
    SELECT drug, avg(cnt) FILTER (WHERE pos < 7) AS l,
           (avg(cnt) FILTER (WHERE pos BETWEEN 7 AND 13) - avg(cnt) FILTER (WHERE pos < 7)) / 7 AS b,
           {", ".join(f"max(cnt) FILTER (WHERE pos = {i}) - avg(cnt) FILTER (WHERE pos < 7) AS s{i}" for i in range(7))}
    FROM filled GROUP BY drug HAVING count(*) >= 60 AND stddev_samp(cnt) > 0),
hw AS (
    SELECT drug, CAST(-1 AS BIGINT) AS pos, l, b, s0, s1, s2, s3, s4, s5, s6, CAST(NULL AS DOUBLE) AS fitted
    FROM start
    UNION ALL
    SELECT drug, pos, nl, {_B} * (nl - l) + (1 - {_B}) * b, s1, s2, s3, s4, s5, s6,
           {_G} * (y - l - b) + (1 - {_G}) * s0, l + b + s0
    FROM (SELECT h.*, f.pos AS pos1, f.cnt AS y, {_A} * (f.cnt - h.s0) + (1 - {_A}) * (h.l + h.b) AS nl
          FROM hw h JOIN filled f ON f.drug = h.drug AND f.pos = h.pos + 1) AS t(drug, old, l, b, s0, s1, s2,
          s3, s4, s5, s6, old_fit, pos, y, nl))"""
# The weight grid, all its recursions side by side, and per drug the weights with the least squared error.
_GRID = """
grid AS (
    SELECT row_number() OVER (ORDER BY a, b, g) AS w, a, b, g
    FROM (SELECT unnest([0.01, 0.1, 0.3, 0.6, 0.9]::DOUBLE[]) AS a), (SELECT unnest([0, 0.05, 0.2]::DOUBLE[]) AS b),
         (SELECT unnest([0, 0.05, 0.2, 0.5]::DOUBLE[]) AS g)
    WHERE b <= a AND g <= 1 - a),
begin_state AS (
    SELECT drug, avg(cnt) FILTER (WHERE pos < 7) AS l,
           (avg(cnt) FILTER (WHERE pos BETWEEN 7 AND 13) - avg(cnt) FILTER (WHERE pos < 7)) / 7 AS t,
           """ + ", ".join(f"max(cnt) FILTER (WHERE pos = {i}) - avg(cnt) FILTER (WHERE pos < 7) AS s{i}" for i in range(7)) + """
    FROM filled GROUP BY drug HAVING count(*) >= 60 AND stddev_samp(cnt) > 0),
folded AS (
    SELECT drug, w, a, b, g, CAST(-1 AS BIGINT) AS pos, l, t, s0, s1, s2, s3, s4, s5, s6,
           CAST(NULL AS DOUBLE) AS fitted, CAST(0 AS DOUBLE) AS sse
    FROM begin_state, grid
    UNION ALL
    SELECT drug, w, a, b, g, pos + 1, nl, b * (nl - l) + (1 - b) * t, s1, s2, s3, s4, s5, s6,
           g * (y - (l + t)) + (1 - g) * s0, l + t + s0, sse + (y - (l + t + s0)) * (y - (l + t + s0))
    FROM (SELECT f.*, d.cnt AS y, f.a * (d.cnt - f.s0) + (1 - f.a) * (f.l + f.t) AS nl
          FROM folded f JOIN filled d ON d.drug = f.drug AND d.pos = f.pos + 1)),
chosen AS MATERIALIZED (
    SELECT drug, arg_min(w, (round_even(sse, 6), w)) AS w FROM folded
    WHERE pos = (SELECT max(pos) FROM filled WHERE filled.drug = folded.drug) GROUP BY drug),
hw AS MATERIALIZED (SELECT drug, pos, fitted FROM folded JOIN chosen USING (drug, w))"""


def _forest():
    """The forest level by level: samples, nodes, and the walk of every day through every tree."""
    values = ["x1", "x2", "x3", "x4", "x5"]
    angle = "2 * pi() * (isodow(date) - 1) / 7"
    parts = [
        f"""feats AS MATERIALIZED (
    SELECT drug, date, cnt, CAST(cnt AS DOUBLE) AS x1, {rnd(f'avg(cnt) OVER {_W7}', 6)} AS x2,
           {rnd(f'coalesce(stddev_samp(cnt) OVER {_W7}, 0)', 6)} AS x3, {rnd(f'sin({angle})', 6)} AS x4,
           {rnd(f'cos({angle})', 6)} AS x5, count(*) OVER (PARTITION BY drug) AS n
    FROM filled)""",
        """drawn AS (
    SELECT *, row_number() OVER (PARTITION BY drug, round
                                 ORDER BY sha256('42/' || drug || '/' || round || '/' || date), date) - 1 AS place
    FROM (SELECT *, greatest(n // 256, 1) AS per_round, unnest(range(CAST(ceil(100 / greatest(n // 256, 1)) AS BIGINT))) AS round
          FROM feats)),
level0 AS MATERIALIZED (
    SELECT drug, CAST(round * per_round + place // 256 AS INTEGER) AS tree, date, least(n, 256) AS psi, 1 AS node,
           x1, x2, x3, x4, x5
    FROM drawn WHERE place // 256 < per_round AND round * per_round + place // 256 < 100)""",
    ]
    columns = ", ".join(values)
    for k in range(9):
        ends = ", ".join(f"min({v}) AS low_{v}, max({v}) AS high_{v}" for v in values)
        lows, highs = "[" + ", ".join(f"low_{v}" for v in values) + "]", "[" + ", ".join(f"high_{v}" for v in values) + "]"
        parts.append(f"""nodes{k} AS MATERIALIZED (
    SELECT drug, tree, node, size, f, CASE WHEN f > 0 THEN lows[f] + part * (highs[f] - lows[f]) END AS cut
    FROM (SELECT *, CASE WHEN {k} < ceil(log2(greatest(psi, 2))) AND len(usable) > 0
                         THEN usable[('0x' || substring(h, 1, 8))::BIGINT % len(usable) + 1] ELSE 0 END AS f,
                 ('0x' || substring(h, 9, 12))::BIGINT / 281474976710656::DOUBLE AS part
          FROM (SELECT *, list_filter([1, 2, 3, 4, 5], lambda i: highs[i] > lows[i]) AS usable,
                       sha256('42/' || drug || '/' || tree || '/' || node) AS h
                FROM (SELECT drug, tree, node, psi, size, {lows} AS lows, {highs} AS highs
                      FROM (SELECT drug, tree, node, psi, count(*) AS size, {ends} FROM level{k}
                            GROUP BY drug, tree, node, psi)))))""")
        if k < 8:
            parts.append(f"""level{k + 1} AS MATERIALIZED (
    SELECT l.drug, l.tree, l.date, l.psi, CASE WHEN [{columns}][f] > cut THEN 2 * l.node + 1 ELSE 2 * l.node END AS node, {columns}
    FROM level{k} l JOIN nodes{k} n ON l.drug = n.drug AND l.tree = n.tree AND l.node = n.node WHERE f > 0)""")
    parts.append("nodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT *, {k} AS depth FROM nodes{k}" for k in range(9)) + ")")
    parts.append("""walk0 AS (
    SELECT drug, date, n, unnest(range(100)) AS tree, 1 AS node, 0 AS depth, x1, x2, x3, x4, x5 FROM feats)""")
    for k in range(8):
        parts.append(f"""walk{k + 1} AS (
    SELECT w.drug, date, n, w.tree, CASE WHEN f > 0 THEN 2 * w.node + CASE WHEN [{columns}][f] > cut THEN 1 ELSE 0 END ELSE w.node END AS node,
           CASE WHEN f > 0 THEN w.depth + 1 ELSE w.depth END AS depth, {columns}
    FROM walk{k} w LEFT JOIN nodes{k} m ON w.drug = m.drug AND w.tree = m.tree AND w.node = m.node)""")

    def units(n):
        path = f"2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / CAST({n} AS DOUBLE)"
        return f"CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1000000 ELSE CAST(round_even(({path}) * 1000000, 0) AS BIGINT) END"

    parts.append(f"""forest_score AS (
    SELECT w.drug, date, {rnd(f"CASE WHEN max(n) <= 1 THEN 0.5 ELSE pow(2, -(sum(w.depth * 1000000 + {units('coalesce(m.size, 0)')}) / CAST(100 * ({units('max(least(n, 256))')}) AS DOUBLE))) END", 9)} AS score
    FROM walk8 w LEFT JOIN nodes m ON w.drug = m.drug AND w.tree = m.tree AND w.node = m.node GROUP BY w.drug, date),
forest AS MATERIALIZED (
    SELECT *, score - quantile_cont(score, 1 - 0.03) OVER (PARTITION BY drug) AS raw_forest FROM forest_score)""")
    return ",\n".join(parts)


_FOREST_SCORE = rnd("raw_forest", 3) + " AS isolation_forest_score"
# Expectation by the grid, the trailing mean where there is none; residual z-score and forest together.
_DETECTED = f"""
modelled AS (
    SELECT f.*, f.cnt - coalesce(h.fitted, avg(f.cnt) OVER (PARTITION BY f.drug ORDER BY f.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
             AS raw_residual,
           coalesce(h.fitted, avg(f.cnt) OVER (PARTITION BY f.drug ORDER BY f.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS expected
    FROM filled f LEFT JOIN hw h ON h.drug = f.drug AND h.pos = f.pos),
rated AS (
    SELECT *, CASE WHEN count(*) OVER {_W30} >= 7 THEN coalesce((raw_residual - avg(raw_residual) OVER {_W30})
             / nullif(stddev_samp(raw_residual) OVER {_W30}, 0), 0) ELSE 0 END AS raw_z
    FROM modelled),
detected AS (
    SELECT r.drug, r.date, r.cnt AS count, {rnd('r.expected', 2)} AS expected_count,
           {rnd('r.cnt - ' + rnd('r.expected', 2), 2)} AS residual, {rnd('raw_z', 2)} AS zscore,
           pos >= 45 AND abs(raw_z) > 2.5 AS is_anomaly_zscore, {_FOREST_SCORE},
           pos >= 45 AND raw_forest > 0 AS is_anomaly_isoforest,
           pos >= 45 AND abs(raw_z) > 2.5 AND raw_forest > 0 AS is_anomaly_high_confidence
    FROM rated r JOIN forest f ON f.drug = r.drug AND f.date = r.date)"""
_FLAT = (
    "safetyreportid, drug, receivedate, patient_sex, patient_age, reactions, drugs_involved, "
    "seriousness_flags, patient_summary_text"
)
_SAMPLE = "QUALIFY row_number() OVER (PARTITION BY drug ORDER BY sha256('42' || safetyreportid), safetyreportid) <="
_PERCENT = "printf('%.1f%%', round_even({} * 1000, 0) / 10)"


def statements():
    """Statement per registered query that SQL can express."""
    s = {}
    s["scan_reports"] = _sql(
        "SELECT safetyreportid, drug, strftime(date, '%Y%m%d') AS receivedate FROM mentions "
        "WHERE date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'",
        "mentions",
    )
    s["reports_mentioning_drug"] = _sql(
        "SELECT safetyreportid, strftime(date, '%Y%m%d') AS receivedate FROM mentions WHERE drug = 'ECONOMY'",
        "mentions",
    )
    s["daily_counts"] = _sql(f"SELECT drug, {_DAY}, cnt AS count FROM daily", "daily")
    s["daily_counts_from_reports"] = _sql(
        f"SELECT drug, {_DAY}, cnt AS count FROM daily",
        "daily",
    )
    s["counts_summary"] = _sql(
        "SELECT drug, count(*) AS n_days, CAST(sum(cnt) AS BIGINT) AS total_reports FROM daily GROUP BY drug",
        "daily",
    )
    s["union_counts"] = _sql(
        f"SELECT drug, {_DAY}, cnt AS count FROM daily UNION ALL SELECT drug, {_DAY}, cnt AS count "
        "FROM events_daily",
        "daily",
        "events_daily",
    )
    s["csv_roundtrip"] = _sql(
        f"""SELECT drug, {_DAY}, cnt AS count, drug || '|a "quoted", tag|it''s' AS tags FROM daily""", "daily"
    )
    s["read_labels_as_strings"] = _sql(
        "SELECT safetyreportid, drug, sha256(text) AS text_digest, predicted_organ_system, predicted_severity, "
        "true_organ_system, true_severity, '' AS notes FROM template",
        "template",
    )
    s["write_counts"] = _sql(f"SELECT drug, {_DAY}, cnt AS count FROM daily", "daily")
    s["write_reports"] = _sql(f"SELECT {_FLAT} FROM summaries", "summaries")
    s["optional_scan"] = _sql(
        "SELECT CAST(0 AS BIGINT) AS done, count(*) AS total, CAST(0 AS DOUBLE) AS percent FROM daily", "daily"
    )
    s["distinct_values"] = _sql("SELECT DISTINCT drug FROM daily ORDER BY drug", "daily")

    s["flatten_reports"] = _sql(f"SELECT {_FLAT} FROM flat", "flat")
    s["summary_text"] = _sql("SELECT safetyreportid, patient_summary_text FROM summaries", "summaries")
    s["array_names"] = _sql(
        "SELECT safetyreportid, len(names) AS n_names, array_to_string(names, '|') AS names FROM reports",
        "reports",
    )
    s["decode_sex"] = _sql("SELECT safetyreportid, sex FROM reports", "reports")
    s["seriousness_flags"] = _sql(
        "SELECT safetyreportid, array_to_string(flags, '|') AS flags FROM reports", "reports"
    )
    s["dedup_reports"] = _sql(
        f"SELECT safetyreportid, drug, {_DAY} FROM mentions "
        f"QUALIFY row_number() OVER (PARTITION BY safetyreportid ORDER BY {_DRUG_POSITION}) = 1",
        "mentions",
    )
    s["cap_per_drug"] = _sql(
        f"SELECT drug, {_DAY}, safetyreportid FROM (SELECT * FROM mentions QUALIFY row_number() OVER "
        "(PARTITION BY drug ORDER BY date, safetyreportid) <= 2000)",
        "mentions",
    )
    s["stratified_cap"] = _sql(f"SELECT drug, safetyreportid FROM mentions {_SAMPLE} 350", "mentions")
    s["stratified_even"] = _sql(
        "SELECT drug, safetyreportid FROM (SELECT * FROM mentions QUALIFY row_number() OVER "
        f"(PARTITION BY safetyreportid ORDER BY {_DRUG_POSITION}) = 1) "
        f"{_SAMPLE} (SELECT greatest(1, 100 // count(DISTINCT drug)) FROM mentions)",
        "mentions",
    )
    s["date_formats"] = (
        "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd, CASE WHEN o_orderstatus <> 'F' "
        "THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed FROM orders"
    )
    s["normalize_array"] = "SELECT p_partkey, lower(p_name) || '|' || lower(p_brand) AS tags FROM part"
    s["join_tags"] = (
        "SELECT p_partkey, CASE WHEN p_size > 5 THEN p_type || '; ' || p_brand ELSE '' END AS tags FROM part"
    )
    s["parse_list_column"] = (
        "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN len(string_split(p_name, ' ')) ELSE 1::BIGINT END AS n, "
        "CASE p_size % 3 WHEN 0 THEN replace(p_name, ' ', '|') WHEN 1 THEN p_name ELSE '[' || p_name END AS items "
        "FROM part"
    )
    s["entity_id"] = _sql(
        f"SELECT drug, {_DAY}, substr(sha256(drug || '_' || date || ' 00:00:00'), 1, 16) AS explanation_id, "
        "substr(sha256(drug || '_' || date), 1, 16) AS score_id, "
        """substr(sha256('{"count": "receivedate", "search": "' || drug || ' ' || date || '"}'), 1, 24) """
        "AS signature FROM daily",
        "daily",
    )
    s["normalize_severity_lookup"] = _sql(
        f"SELECT safetyreportid, drug, {_lookup(_SEVERITY_RAW)} AS severity FROM mentions", "mentions"
    )
    raw = (
        "CASE WHEN disabling THEN 'non-serious/other and ' || array_to_string(flags, '|') "
        "WHEN len(flags) = 0 THEN CASE WHEN sex_given IS NOT NULL THEN 'Non-Serious/other' END "
        "ELSE upper(array_to_string(flags, '|')) END"
    )
    s["normalize_severity_ladder"] = _sql(
        f"SELECT safetyreportid, {_ladder('raw')} AS severity FROM (SELECT safetyreportid, {raw} AS raw "
        "FROM reports)",
        "reports",
    )

    s["merge_labels"] = _sql(
        "SELECT safetyreportid, s.drug, receivedate, primary_organ_system, l.severity "
        "FROM summaries s JOIN first_labels l USING (safetyreportid)",
        "summaries",
        "first_labels",
    )
    s["normalized_count"] = _sql(
        f"SELECT count(*) FILTER (WHERE lower({_strip('severity_before')}) IS DISTINCT FROM severity) AS n_changed, "
        f"count(*) FILTER (WHERE lower({_strip('given')}) IS DISTINCT FROM {_ladder('given')}) AS n_changed_by_ladder, "
        "count(*) AS n FROM (SELECT *, nullif(severity_before, 'odd') AS given FROM first_labels)",
        "first_labels",
    )
    s["pending_anti"] = (
        "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
    )
    s["progress_status"] = (
        f"SELECT done, total, CASE WHEN total > 0 THEN {rnd('done / total * 100', 6)} ELSE 0.0 END AS percent "
        "FROM (SELECT (SELECT count(*) FROM labels) AS done, (SELECT count(*) FROM documents) AS total)"
    )
    s["make_batches"] = _sql("SELECT bucket, batch, n_items, request_digest FROM batches", "batches")
    s["batch_id"] = _sql("SELECT batch_id, n_items FROM batches", "batches")
    s["explode_label_batches"] = _sql(
        "SELECT batch_id, row_number() OVER (PARTITION BY bucket, batch ORDER BY safetyreportid) - 1 AS position, "
        "safetyreportid AS id, length(patient_summary_text) AS text_length "
        "FROM numbered JOIN batches USING (bucket, batch)",
        "numbered",
        "batches",
    )
    s["done_ids"] = _sql("SELECT DISTINCT safetyreportid AS id FROM numbered", "numbered")
    s["parse_model_json"] = (
        "SELECT CAST(o_orderkey AS VARCHAR) AS safetyreportid, CAST(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE -1 END "
        "AS BIGINT) AS n_reports, CASE WHEN o_orderstatus = 'P' THEN lower(o_orderpriority) END AS severity, "
        "CASE o_orderstatus WHEN 'F' THEN 'invalid json' WHEN 'O' THEN 'missing reports' END AS reject_reason "
        "FROM orders"
    )
    s["json_results_scan"] = _sql(
        "SELECT batch_id, row_number() OVER (PARTITION BY bucket, batch ORDER BY safetyreportid) - 1 AS position, "
        "safetyreportid AS id, 'mild' AS severity FROM numbered JOIN batches USING (bucket, batch)",
        "numbered",
        "batches",
    )
    s["json_tolerant_scan"] = (
        "SELECT CASE o_orderstatus WHEN 'P' THEN 'label' ELSE 'skipped' END AS kind, "
        "CAST(o_orderkey AS VARCHAR) AS id, CASE o_orderstatus WHEN 'P' THEN lower(o_orderpriority) END AS severity "
        "FROM orders WHERE o_orderstatus IN ('P', 'F')"
    )
    s["incremental_run"] = _sql(
        "SELECT drug, safetyreportid FROM (SELECT * FROM mentions QUALIFY row_number() OVER "
        f"(PARTITION BY safetyreportid ORDER BY {_DRUG_POSITION}) = 1) {_SAMPLE} 600",
        "mentions",
    )
    s["categorize_rules"] = _sql(
        "SELECT safetyreportid AS id, primary_organ_system, severity, products[1] AS likely_causal_drug, "
        "'known_side_effect' || CASE WHEN len(products) > 1 THEN '|drug_interaction_suspected' ELSE '' END "
        "|| CASE WHEN severity = 'fatal' THEN '|fatal_outcome' ELSE '' END AS category_tags, "
        "'Keyword rules matched ' || primary_organ_system || '.' AS rationale FROM categorized",
        "categorized",
    )
    s["categorize_mapinpandas"] = s["categorize_rules"]
    s["inference_errors"] = (
        "WITH n AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY id) - 1) / 5) AS INT) AS batch "
        "FROM (SELECT CAST(doc_id AS VARCHAR) AS id, text, CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) "
        f"AS BIGINT) % {BATCH_BUCKETS} AS bucket FROM documents)), g AS (SELECT bucket, batch, "
        f"bool_or({_toxic('text')}) AS bad, substr(sha256('[\"' || string_agg(id, '\", \"' ORDER BY id) || '\"]'), 1, 24) "
        "AS batch_id FROM n GROUP BY bucket, batch) SELECT batch_id, id, CASE WHEN NOT bad THEN length(text) END AS n, "
        "CASE WHEN bad THEN 'ValueError: refused' END AS error FROM n JOIN g USING (bucket, batch)"
    )
    s["embed_model"] = (
        "SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang <> 'de' THEN source ELSE '' END AS drug, "
        "CAST(length(text) AS DOUBLE) AS length, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS blanks "
        "FROM documents"
    )
    s["judge_model"] = _sql(
        f"SELECT substr(sha256(drug || '_' || date), 1, 16) AS entity_id, drug, {_DAY}, CAST(0.5 AS DOUBLE) AS score, "
        "sha256('SOURCES:' || chr(10) || context || chr(10) || chr(10) || 'CLAIM:' || chr(10) || claim) AS justification "
        "FROM claims JOIN bundle USING (drug, date)",
        "claims",
        "bundle",
    )

    s["gap_fill"] = _sql(f"SELECT drug, {_DAY}, cnt AS count FROM filled", "filled")
    s["rolling_mean_7"] = _sql(
        f"SELECT drug, {_DAY}, {rnd('expected', 6)} AS mean_7 FROM scored", "scored"
    )
    std = f"coalesce(stddev_samp(cnt) OVER {_W7}, 0)"
    s["rolling_std_7"] = _sql(f"SELECT drug, {_DAY}, {rnd(std, 6)} AS std_7 FROM filled", "filled")
    s["rolling_zscore"] = _sql(f"SELECT drug, {_DAY}, {rnd('raw_z', 6)} AS zscore FROM scored", "scored")
    s["residuals"] = _sql(f"SELECT drug, {_DAY}, expected_count, residual, zscore FROM pub", "pub")
    s["zscore_flags"] = _sql(
        f"SELECT drug, {_DAY}, abs(raw_z) > 2.5 AS is_anomaly_zscore FROM scored", "scored"
    )
    s["warmup_mask"] = _sql(
        f"SELECT drug, {_DAY}, abs(raw_z) > 2.5 AS flag_before, pos >= 45 AND abs(raw_z) > 2.5 AS flag_after "
        "FROM scored",
        "scored",
    )
    s["holt_winters_fixed"] = _sql(
        "SELECT f.drug, CAST(f.date AS VARCHAR) AS date, "
        f"{rnd('h.fitted', 4)} AS fitted FROM filled f LEFT JOIN hw h ON h.drug = f.drug AND h.pos = f.pos",
        "filled",
        recursive=_HW,
    )
    s["expected_with_fallback"] = _sql(
        f"SELECT drug, {_DAY}, cnt AS count, {rnd(f'avg(cnt) OVER {_W7}', 6)} AS expected FROM ("
        + CTES["filled"].replace("daily", "events_daily")
        + ")",
        "events_daily",
    )
    angle = "2 * pi() * (isodow(date) - 1) / 7"
    s["iforest_features"] = _sql(
        f"SELECT drug, {_DAY}, cnt AS count, {rnd(f'avg(cnt) OVER {_W7}', 6)} AS roll_mean_7, "
        f"{rnd(std, 6)} AS roll_std_7, {rnd(f'sin({angle})', 6)} AS dow_sin, {rnd(f'cos({angle})', 6)} AS dow_cos "
        "FROM filled",
        "filled",
    )
    s["holt_winters_fit"] = _sql(
        "SELECT f.drug, CAST(f.date AS VARCHAR) AS date, f.cnt AS count, "
        f"{rnd('h.fitted', 4)} AS fitted FROM filled f LEFT JOIN hw h ON h.drug = f.drug AND h.pos = f.pos",
        "filled",
        recursive=_GRID,
    )
    s["isolation_sample"] = _sql(f"SELECT drug, tree, {_DAY} FROM level0", "filled", recursive=_forest())
    names = "['count', 'roll_mean_7', 'roll_std_7', 'dow_sin', 'dow_cos']"
    s["isolation_nodes"] = _sql(
        f"SELECT drug, tree, node, CASE WHEN f > 0 THEN {names}[f] END AS feature, {rnd('cut', 6)} AS threshold, "
        "CAST(size AS INTEGER) AS size FROM nodes",
        "filled",
        recursive=_forest(),
    )
    s["isolation_forest"] = _sql(
        f"SELECT f.drug, CAST(f.date AS VARCHAR) AS date, f.cnt AS count, {_FOREST_SCORE}, "
        "raw_forest > 0 AS is_anomaly_isoforest FROM forest s JOIN filled f ON f.drug = s.drug AND f.date = s.date",
        "filled",
        recursive=_forest(),
    )
    s["anomaly_table"] = _sql(
        f"SELECT {_DAY}, detected.* EXCLUDE (date) FROM detected", "filled", recursive=f"{_GRID},\n{_forest()},{_DETECTED}"
    )
    s["anomaly_table_totals"] = _sql(
        "SELECT drug, count(*) AS n_days, CAST(sum(count) AS BIGINT) AS total_reports, "
        + ", ".join(f"count(*) FILTER (WHERE is_anomaly_{c}) AS n_{c}" for c in ("zscore", "isoforest", "high_confidence"))
        + " FROM detected GROUP BY drug",
        "filled",
        recursive=f"{_GRID},\n{_forest()},{_DETECTED}",
    )
    s["anomaly_direction"] = _sql(
        f"SELECT drug, {_DAY}, CASE WHEN zscore >= 0 THEN 'SPIKE (higher than expected)' "
        "ELSE 'DROP (lower than expected)' END AS direction FROM pub",
        "pub",
    )
    pub = f"drug, {_DAY}, count, expected_count, residual, zscore, is_anomaly_zscore"
    s["high_confidence"] = _sql(f"SELECT {pub} FROM flagged", "flagged")
    s["anomaly_totals"] = _sql(
        "SELECT coalesce(drug, 'ALL') AS drug, count(*) FILTER (WHERE is_anomaly_zscore) AS n_anomalies "
        "FROM pub GROUP BY ROLLUP (drug)",
        "pub",
    )
    s["drug_timeline"] = _sql(f"SELECT {pub} FROM pub WHERE drug = 'ECONOMY' ORDER BY pub.date", "pub")
    s["flagged_for_drug"] = _sql(
        f"SELECT {_DAY}, count, expected_count, zscore FROM flagged WHERE drug = 'ECONOMY'", "flagged"
    )

    s["l2_normalize"] = _sql(
        f"SELECT id, len(v) AS dim, CAST(1 AS DOUBLE) AS norm, {rnd('v[1] / n', 6)} AS first, {rnd('v[len(v)] / n', 6)} AS last "
        "FROM (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM vecs)",
        "vecs",
    )
    for name, condition in (("knn_topk", "true"), ("knn_filtered", "label = '3'")):
        s[name] = _sql(
            f"SELECT query, id, {rnd('s', 6)} AS similarity, rank FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY query ORDER BY s DESC, id) AS rank FROM sims WHERE {condition}) WHERE rank <= 5",
            "sims",
        )
    for name, condition in (("knn_lsh", "true"), ("knn_lsh_filtered", "label = '3'")):
        s[name] = _sql(
            f"SELECT query, id, {rnd('s', 6)} AS similarity, rank FROM (SELECT *, row_number() OVER "
            "(PARTITION BY query ORDER BY s DESC, id) AS rank FROM sims "
            f"WHERE {condition} AND (query, id) IN (SELECT query, id FROM candidates)) WHERE rank <= 5",
            "sims",
            "candidates",
        )
    s["vector_upsert"] = _sql(
        f"SELECT id, CASE WHEN label = '3' THEN 'updated' ELSE label END AS primary_organ_system, "
        f"{rnd('v[1]', 6)} AS first FROM vecs UNION ALL "
        f"SELECT 'new-' || id, label, {rnd('v[1]', 6)} FROM vecs WHERE label = '4'",
        "vecs",
    )
    s["vector_store_upsert"] = s["vector_upsert"]
    s["vector_metadata"] = (
        "SELECT CAST(doc_id AS VARCHAR) AS safetyreportid, CASE WHEN lang <> 'de' THEN source ELSE '' END AS drug, "
        "lang AS primary_organ_system, '' AS severity, '' AS likely_causal_drug, "
        "lang || '; ' || source AS category_tags, CAST(n_chars AS VARCHAR) AS receivedate FROM documents"
    )

    s["vector_build"] = (
        "SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang <> 'de' THEN source ELSE '' END AS drug, "
        "lang AS primary_organ_system, CAST(384 AS BIGINT) AS dim FROM documents"
    )
    s["embed_documents"] = (
        "SELECT CAST(doc_id AS VARCHAR) AS id, CAST(384 AS BIGINT) AS dim, "
        r"CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM documents"
    )

    s["context_interval_join"] = _sql(
        f"SELECT drug, {_DAY}, safetyreportid, CAST(received AS VARCHAR) AS received, distance FROM near", "near"
    )
    s["context_topn"] = _sql(
        f"SELECT drug, {_DAY}, position, safetyreportid, CAST(received AS VARCHAR) AS received FROM top8", "top8"
    )
    s["context_bundle"] = _sql(f"SELECT drug, {_DAY}, n_context_reports, context FROM bundle", "bundle")
    s["stats_block"] = _sql(
        "SELECT drug, CAST(date AS VARCHAR) AS date, 'Drug: ' || drug || chr(10) || 'Date: ' || date "
        "|| ' 00:00:00' || chr(10) || 'Direction: ' || CASE WHEN zscore >= 0 THEN 'SPIKE (higher than expected)' "
        "ELSE 'DROP (lower than expected)' END || chr(10) || 'Actual report count that day: ' || count || chr(10) "
        "|| 'Expected count (Holt-Winters forecast): ' || expected_count || chr(10) || 'Z-score: ' || zscore "
        "|| chr(10) || 'Sample of ' || n_context_reports || ' reports from +/-3 days:' || chr(10) || context "
        "AS stats FROM flagged JOIN bundle USING (drug, date)",
        "flagged",
        "bundle",
    )
    s["explain_model"] = _sql(
        "SELECT drug, f.date AS date, f.count AS count, zscore, n_context_reports, sha256(stats) AS summary, 'x' AS organs "
        f"FROM (SELECT drug, CAST(date AS VARCHAR) AS date, count, zscore FROM flagged) f JOIN ("
        + s["stats_block"][s["stats_block"].rindex("SELECT drug, CAST(date") :]
        + ") USING (drug, date) JOIN (SELECT drug, CAST(date AS VARCHAR) AS date, n_context_reports FROM bundle) USING (drug, date)",
        "flagged",
        "bundle",
    )
    s["explain_extractive"] = _sql(
        f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM explained", "explained"
    )
    s["claim_text"] = _sql(f"SELECT drug, {_DAY}, claim FROM claims", "claims")
    s["faithfulness"] = _sql(f"SELECT drug, {_DAY}, {rnd('score', 6)} AS score FROM scores", "scores")
    s["faithfulness_summary"] = _sql(
        f"SELECT {rnd('avg(score)', 6)} AS mean_score, count(*) AS n FROM scores", "scores"
    )
    s["faithfulness_ranked"] = _sql(
        f"SELECT drug, {_DAY}, {rnd('score', 6)} AS score, 'Words of the claim found in the sources: ' || "
        f"{_PERCENT.format('score')} AS justification FROM scores ORDER BY score",
        "scores",
    )
    s["explanations_merge"] = _sql(f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM collected", "collected")
    s["explanations_sorted"] = _sql(f"SELECT drug, {_DAY}, dominant_severity FROM collected", "collected")
    s["explanations_filter"] = _sql(
        f"SELECT drug, {_DAY}, dominant_severity, zscore FROM collected WHERE drug IN ('ECONOMY', 'SMALL') "
        "AND dominant_severity IN ('fatal', 'life-threatening')",
        "collected",
    )
    s["explanations_shown"] = _sql(
        "SELECT count(*) FILTER (WHERE drug IN ('ECONOMY', 'SMALL')) AS shown, count(*) AS total FROM collected",
        "collected",
    )
    s["labeling_template"] = _sql(
        "SELECT safetyreportid, drug, patient_summary_text, primary_organ_system AS predicted_organ_system, "
        "severity AS predicted_severity, '' AS true_organ_system, '' AS true_severity, '' AS notes "
        f"FROM categorized {_SAMPLE} (SELECT greatest(1, 100 // count(DISTINCT drug)) FROM categorized)",
        "categorized",
    )
    s["categorization_accuracy"] = _sql(
        f"SELECT n_labelled, {rnd('organ_accuracy', 6)} AS organ_accuracy, {rnd('severity_accuracy', 6)} "
        "AS severity_accuracy, n_mismatches FROM accuracy",
        "accuracy",
    )
    s["label_mismatches"] = _sql("SELECT * FROM mismatches", "mismatches")
    s["report_lines"] = _sql(
        "SELECT 0 AS line_no, 'Categorization Accuracy Report' AS line UNION ALL SELECT 1, repeat('=', 40) "
        "UNION ALL SELECT 2, 'Labeled sample size: ' || n_labelled FROM accuracy "
        f"UNION ALL SELECT 3, 'Organ system accuracy: ' || {_PERCENT.format('organ_accuracy')} FROM accuracy "
        f"UNION ALL SELECT 4, 'Severity accuracy: ' || {_PERCENT.format('severity_accuracy')} FROM accuracy "
        "UNION ALL SELECT 5, '' UNION ALL SELECT 6, 'Mismatches (' || n_mismatches || '):' FROM accuracy "
        "UNION ALL SELECT 6 + row_number() OVER (ORDER BY line), line FROM (SELECT '  - ' || safetyreportid "
        "|| ': predicted=''' || predicted_organ_system || ''' true=''' || true_organ_system || '''' AS line "
        "FROM mismatches)",
        "accuracy",
        "mismatches",
    )
    s["anomaly_precision"] = _sql(
        "SELECT count(*) AS n_flagged, count(*) FILTER (WHERE zscore >= 2.6) AS n_labelled, "
        f"count(*) FILTER (WHERE zscore >= 3) AS n_confirmed, "
        + rnd("count(*) FILTER (WHERE zscore >= 3) / count(*) FILTER (WHERE zscore >= 2.6)", 6)
        + " AS precision FROM flagged",
        "flagged",
    )
    known = {"is_real_signal": ("Y", "N"), "notes": ("known", ""), "fda_reference_url": ("", "https://example.org")}
    seeded = ", ".join(
        f"CASE WHEN drug = 'ECONOMY' AND date = DATE '1996-05-13' THEN '{a}' "
        f"WHEN drug = 'SMALL' AND date = DATE '1997-02-03' THEN '{z}' ELSE '' END AS {c}"
        for c, (a, z) in known.items()
    )
    s["seed_ground_truth"] = _sql(f"SELECT drug, {_DAY}, count, {seeded} FROM pub", "pub")

    s["overview_kpis"] = _sql(
        "SELECT (SELECT count(DISTINCT drug) FROM daily) AS n_drugs, n_reports, "
        "(SELECT count(*) FROM flagged) AS n_anomalies, "
        "(SELECT CAST(min(date) AS VARCHAR) FROM daily) AS first_day, "
        "(SELECT CAST(max(date) AS VARCHAR) FROM daily) AS last_day, format('{:,}', n_reports) AS n_reports_text "
        "FROM (SELECT count(DISTINCT safetyreportid) AS n_reports FROM mentions)",
        "daily",
        "flagged",
        "mentions",
    )
    for name, column in (("value_counts_organ", "primary_organ_system"), ("value_counts_severity", "severity")):
        s[name] = _sql(f"SELECT {column}, count(*) AS n FROM categorized GROUP BY {column}", "categorized")

    s["stream_ingest"] = "SELECT DISTINCT event_id, event_type, user_id, value FROM events"
    s["stream_daily_counts"] = _sql(f"SELECT drug, {_DAY}, cnt AS count FROM events_daily", "events_daily")
    return s
