"""DuckDB counterparts of the registered queries, over the same fixture views."""

from __future__ import annotations

from lymphoframe.functions.codons import codon_table
from lymphoframe.sources.fixtures import with_views


def _added(values: str) -> str:
    """A list of doubles added from its first value on: the order is part of the result."""
    return f"list_reduce(list_prepend(cast(0 AS double), {values}), lambda a, x: a + x)"


def _moments(values: str, n: str) -> tuple[str, str]:
    """Mean and sample deviation of ``n`` values, those beyond the list 0."""
    mean = f"({_added(values)} / {n})"
    squares = f"{_added(f'list_transform({values}, lambda y: (y - {mean}) * (y - {mean}))')} + ({n} - len({values})) * ({mean} * {mean})"
    return mean, f"CASE WHEN {n} > 1 THEN sqrt(({squares}) / ({n} - 1)) ELSE 0 END"


_BASE = """
gn AS (SELECT label, label AS allele, concat(locus, sequence_type, gene_designation) AS gene,
  CASE WHEN subgroup_designation IS NULL THEN concat(locus, sequence_type, gene_designation) ELSE concat(locus, sequence_type, subgroup_designation) END AS subgroup FROM germline),
rr AS (SELECT *, coalesce(duplicate_count, 1) AS w, coalesce(productive, false) AS prod FROM rearrangements),
calls AS (SELECT sequence_id, 'v_call' AS field, v_call AS call FROM rr UNION ALL SELECT sequence_id, 'd_call', d_call FROM rr UNION ALL SELECT sequence_id, 'j_call', j_call FROM rr UNION ALL SELECT sequence_id, 'c_call', c_call FROM rr),
labels AS (SELECT sequence_id, field, unnest(string_split(call, ',')) AS label, unnest(range(1, len(string_split(call, ',')) + 1)) AS p FROM calls),
hits AS (SELECT l.sequence_id, l.field, l.p, gn.allele, gn.gene, gn.subgroup FROM labels l JOIN gn ON l.label = gn.label),
alln AS (SELECT sequence_id, field, p, 'allele' AS level, allele AS name FROM hits UNION ALL SELECT sequence_id, field, p, 'gene', gene FROM hits UNION ALL SELECT sequence_id, field, p, 'subgroup', subgroup FROM hits),
named0 AS (SELECT sequence_id, field, level, name, min(p) AS p FROM alln GROUP BY sequence_id, field, level, name),
named AS (SELECT *, count(*) OVER (PARTITION BY sequence_id, field, level) AS n FROM named0),
joined AS (SELECT sequence_id, field, level, string_agg(name, ',' ORDER BY p) AS names FROM named0 GROUP BY sequence_id, field, level),
flags AS (SELECT sequence_id, bool_or(field = 'v_call' AND level = 'subgroup' AND name = 'IGHV4') AS v4, bool_or(field = 'v_call' AND level = 'subgroup' AND name = 'IGHV3') AS v3, bool_or(field = 'j_call' AND level = 'subgroup' AND name = 'IGHJ6') AS j6 FROM named0 GROUP BY sequence_id),
members AS (SELECT DISTINCT repertoire_group_id, repertoire_id FROM group_members),
rl AS (SELECT * REPLACE (coalesce(junction_aa_length, cast(length(junction_aa) AS bigint)) AS junction_aa_length) FROM rr),
"""
_GROUPED = """ AS (SELECT m.repertoire_group_id, x.* FROM {} x JOIN members m ON x.repertoire_id = m.repertoire_id LEFT JOIN flags f ON x.sequence_id = f.sequence_id
  WHERE CASE m.repertoire_group_id WHEN 'g_len12' THEN coalesce(junction_aa_length = 12, false) WHEN 'g_long' THEN coalesce(junction_aa_length > 15, false)
    WHEN 'g_v4' THEN coalesce(v4, false) WHEN 'g_v4_j6' THEN coalesce(v4, false) AND coalesce(j6, false) WHEN 'g_v3_or_v4' THEN coalesce(v3, false) OR coalesce(v4, false) ELSE true END)"""
#: ``gr``: group rows; ``gl``: group rows for lengths, a missing length filled in before the filter.
_BASE += "gr" + _GROUPED.format("rr") + ",\ngl" + _GROUPED.format("rl")
_VIEWS = ("germline", "rearrangements", "group_members")


def sql(body: str, *more: str, base: str = _BASE, views: tuple[str, ...] = _VIEWS) -> str:
    """``body`` is CTEs and the final SELECT; ``base`` comes before them."""
    return with_views(f"WITH {base.strip()}{',' if base.strip() and not body.lstrip().upper().startswith('SELECT') else ''}\n{body.strip()}" if base.strip() else body, *views, *more)


ORACLES: dict[str, str] = {}

# -- germline, groups, filters -------------------------------------------------------------------

_pick = ",\n".join(f"coalesce(max(CASE WHEN field = '{s}_call' AND level = '{lv}' THEN names END), '') AS {s}_{lv}" for s in "vj" for lv in ("allele", "gene", "subgroup"))
ORACLES["germline_resolve"] = sql(f"SELECT rr.sequence_id, {_pick} FROM rr LEFT JOIN joined j ON rr.sequence_id = j.sequence_id GROUP BY rr.sequence_id")
ORACLES["group_membership"] = sql("SELECT m.repertoire_group_id, m.repertoire_id, count(*) AS n FROM rr JOIN group_members m ON rr.repertoire_id = m.repertoire_id GROUP BY m.repertoire_group_id, m.repertoire_id")
ORACLES["group_missing_members"] = sql("SELECT repertoire_group_id, repertoire_id FROM nation_members WHERE repertoire_id NOT IN (SELECT DISTINCT repertoire_id FROM rr)", "nation_members")
ORACLES["filter_repertoire_selection"] = sql("SELECT sequence_id, repertoire_id, productive FROM rr WHERE repertoire_id IN ('rep1', 'rep3', 'rep5')")
ORACLES["filter_group_rows"] = sql("SELECT repertoire_group_id, repertoire_id, sequence_id FROM gr")


def _where(condition: str) -> str:
    return sql(f"SELECT rr.sequence_id, repertoire_id FROM rr LEFT JOIN flags f ON rr.sequence_id = f.sequence_id WHERE {condition}")


def _has(field: str, level: str, name: str) -> str:
    return f"rr.sequence_id IN (SELECT sequence_id FROM named0 WHERE field = '{field}' AND level = '{level}' AND name = '{name}')"


ORACLES["filter_eq_scalar"] = _where("junction_aa_length = 12")
ORACLES["filter_eq_derived_list"] = _where(_has("v_call", "gene", "IGHV3-2"))
ORACLES["filter_ne"] = _where("duplicate_count <> 7 AND duplicate_count <> 0")
ORACLES["filter_ne_derived_list"] = _where(f"rr.sequence_id IN (SELECT sequence_id FROM named0 WHERE field = 'j_call' AND level = 'subgroup') AND NOT {_has('j_call', 'subgroup', 'IGHJ2')}")
ORACLES["filter_range"] = _where("duplicate_count >= 10 AND junction_aa_length < 9 AND junction_aa_length <> 0")
ORACLES["filter_contains"] = _where("contains(junction_aa, 'CAS')")
ORACLES["filter_contains_list"] = _where(_has("v_call", "subgroup", "TRBV3"))
ORACLES["filter_and"] = _where("v4 AND j6")
ORACLES["filter_or"] = _where("v3 OR v4")
ORACLES["filter_nested"] = _where("coalesce(v4 AND j6, false) OR coalesce(junction_aa_length > 18, false)")
ORACLES["clone_input_filter"] = sql("SELECT sequence_id, repertoire_id, junction_aa FROM rr WHERE contains(locus, 'TR') AND prod AND junction_aa <> ''")

# -- segment usage -------------------------------------------------------------------------------


def _counted(keys: str, source: str) -> str:
    """CTEs ``counts`` and ``whole`` (the rows that have a name at all) from a source with keys, prod, w, name, n."""
    return f"""src AS ({source}),
split AS (SELECT *, false AS productive FROM src UNION ALL SELECT *, true FROM src WHERE prod),
parts AS (SELECT {keys}, productive, name, n, cast(count(*) AS double) AS r, cast(sum(w) AS double) AS w FROM split GROUP BY {keys}, productive, name, n),
whole AS (SELECT {keys}, productive, sum(r / n) AS whole_sequence, sum(w / n) AS whole_duplicate FROM (SELECT {keys}, productive, n, sum(r) AS r, sum(w) AS w FROM parts GROUP BY {keys}, productive, n) GROUP BY {keys}, productive),
totals AS (SELECT {keys}, productive, name, sum(CASE WHEN n = 1 THEN r ELSE 0 END) AS us, sum(CASE WHEN n = 1 THEN w ELSE 0 END) AS ud,
  sum(r) AS es, sum(w) AS ed, {_added("list(r / n ORDER BY n)")} AS ps, {_added("list(w / n ORDER BY n)")} AS pd FROM parts GROUP BY {keys}, productive, name),
counts AS (SELECT {keys}, productive, name, 'unique' AS mode, us AS sequence_count, ud AS duplicate_count FROM totals WHERE us > 0
  UNION ALL SELECT {keys}, productive, name, 'exists', es, ed FROM totals UNION ALL SELECT {keys}, productive, name, 'proportion', ps, pd FROM totals)"""


def _frequency_columns(keys: str) -> str:
    """Shares; a row's shares among its names make 1, so the whole of mode proportion is a number of rows."""
    out = ""
    for m in ("sequence", "duplicate"):
        t = f"(CASE WHEN mode = 'proportion' THEN whole_{m} ELSE sum({m}_count) OVER (PARTITION BY {keys}, mode, productive) END)"
        out += f", CASE WHEN {t} = 0 THEN 0 ELSE {m}_count / {t} END AS {m}_frequency"
    return out


def _final(keys: str, frequency: bool, where: str = "true") -> str:
    more = _frequency_columns(keys) if frequency else ""
    return f"SELECT {keys}, mode, productive, name, sequence_count, duplicate_count{more} FROM counts JOIN whole USING ({keys}, productive) WHERE {where}"


def _fields(segments: str) -> str:
    return "(" + ", ".join(f"'{s}_call'" for s in segments) + ")"


def _usage(keys: str, rows: str, segments: str = "vdjc", frequency: bool = False, where: str = "true") -> str:
    source = f"SELECT {keys}, field, level, prod, w, name, n FROM {rows} r JOIN named x ON r.sequence_id = x.sequence_id WHERE field IN {_fields(segments)}"
    return sql(_counted(f"{keys}, field, level", source) + "\n" + _final(f"{keys}, field, level", frequency, where))


ORACLES["usage_unique"] = _usage("repertoire_id", "rr", "v", where="mode = 'unique'")
ORACLES["usage_exists"] = _usage("repertoire_id", "rr", "v", True, "mode = 'exists'")
ORACLES["usage_proportion"] = _usage("repertoire_id", "rr", "v", where="mode = 'proportion'")
ORACLES["usage_levels"] = _usage("repertoire_id", "rr", "j")
ORACLES["usage_fields"] = _usage("repertoire_id", "rr")
ORACLES["usage_frequency"] = _usage("repertoire_id", "rr", frequency=True)
ORACLES["group_usage_pooled"] = _usage("repertoire_group_id", "gr", "vj")
ORACLES["group_repertoire_usage"] = _usage("repertoire_group_id, repertoire_id", "gr", "v")


def _combo_source(combo: str, keys: str, rows: str) -> str:
    parts = {"vj": "vj", "vd": "vd", "vdj": "vdj", "dj": "dj"}[combo]
    name = " || '|' || ".join("coalesce(d.name, 'NONE')" if s == "d" else f"{s}.name" for s in parts)
    n = " * ".join("coalesce(d.n, 1)" if s == "d" else f"{s}.n" for s in parts)
    joins = "".join(f" {'LEFT ' if s == 'd' else ''}JOIN named {s} ON {s}.sequence_id = r.sequence_id AND {s}.field = '{s}_call' AND {s}.level = l.level" for s in parts)
    return f"SELECT {keys}, '{combo}' AS combo, l.level, prod, w, {name} AS name, {n} AS n FROM {rows} r CROSS JOIN (SELECT unnest(['allele', 'gene', 'subgroup']) AS level) l{joins}"


def _combo(combo: str, frequency: bool = False) -> str:
    return sql(_counted("repertoire_id, combo, level", _combo_source(combo, "repertoire_id", "rr")) + "\n" + _final("repertoire_id, combo, level", frequency))


for _c in ("vj", "vd", "vdj", "dj"):
    ORACLES[f"combo_{_c}"] = _combo(_c)
ORACLES["combo_frequency"] = _combo("vj", True)


def _stats(keys: str, values: str, measures: list[str]) -> str:
    """Mean and deviation over members, absent values 0; ``values``: CTE with group, repertoire, keys, measures."""
    lists = ", ".join(f"list(cast({m} AS double) ORDER BY repertoire_id) AS l_{m}" for m in measures)
    agg = ", ".join(f"{e} AS {m}_{x}" for m in measures for x, e in zip(("avg", "std"), _moments(f"l_{m}", "N"), strict=True))
    return f"""sizes AS (SELECT repertoire_group_id, count(*) AS N FROM members GROUP BY repertoire_group_id),
lists AS (SELECT repertoire_group_id, {keys}, {lists} FROM {values} GROUP BY repertoire_group_id, {keys})
SELECT repertoire_group_id, {keys}, N, {agg} FROM lists JOIN sizes USING (repertoire_group_id)"""


def _member_frequency(keys: str) -> str:
    return f"vals AS (SELECT {keys}, mode, productive, name, sequence_count, duplicate_count{_frequency_columns(keys)} FROM counts JOIN whole USING ({keys}, productive))"


_M = ["sequence_count", "sequence_frequency", "duplicate_count", "duplicate_frequency"]
_K = "repertoire_group_id, repertoire_id"
_src = f"SELECT {_K}, field, level, prod, w, name, n FROM gr r JOIN named x ON r.sequence_id = x.sequence_id WHERE field = 'v_call'"
ORACLES["group_usage_stats"] = sql(_counted(f"{_K}, field, level", _src) + ",\n" + _member_frequency(f"{_K}, field, level") + ",\n" + _stats("field, level, mode, productive, name", "vals", _M))
_src = _combo_source("vj", _K, "gr") + " WHERE l.level = 'subgroup'"
ORACLES["group_combo_stats"] = sql(_counted(f"{_K}, combo, level", _src) + ",\n" + _member_frequency(f"{_K}, combo, level") + ",\n" + _stats("combo, level, mode, productive, name", "vals", _M))

# -- junction lengths and letters ----------------------------------------------------------------


def _lengths(kind: str, by: str = "repertoire_id", rows: str = "rr", weighted: bool = True) -> str:
    length = "coalesce(junction_aa_length, cast(length(junction_aa) AS bigint))" if kind == "aa" else "junction_length"
    count = "cast(sum(w) AS double)" if weighted else "cast(count(*) AS double)"
    return f"""src AS (SELECT {by}, prod, w, {length} AS length FROM {rows}),
split AS (SELECT *, false AS productive FROM src WHERE length > 0 UNION ALL SELECT *, true FROM src WHERE prod AND length > 0),
h AS (SELECT {by}, productive, length, {count} AS count FROM split GROUP BY {by}, productive, length)"""


ORACLES["length_aa"] = sql(_lengths("aa") + "\nSELECT * FROM h")
ORACLES["length_nt"] = sql(_lengths("nt") + "\nSELECT * FROM h")
ORACLES["length_aa_wo_dup"] = sql(_lengths("aa", weighted=False) + "\nSELECT * FROM h")
ORACLES["length_nt_wo_dup"] = sql(_lengths("nt", weighted=False) + "\nSELECT * FROM h")
ORACLES["length_dense"] = sql(_lengths("aa") + """,
grid AS (SELECT repertoire_id, productive, unnest(range(0, max(length) + 1)) AS length FROM h GROUP BY repertoire_id, productive)
SELECT g.repertoire_id, g.productive, g.length, coalesce(h.count, 0) AS count FROM grid g LEFT JOIN h ON g.repertoire_id = h.repertoire_id AND g.productive = h.productive AND g.length = h.length""")
ORACLES["length_relative"] = sql(_lengths("aa") + f"\nSELECT *, count / sum(count) OVER (PARTITION BY repertoire_id, productive) AS relative FROM h")
ORACLES["length_table_stats"] = sql(_lengths("aa") + f"\nSELECT repertoire_id, productive, sum(count) AS total, sum(length * count) / sum(count) AS avg FROM h GROUP BY repertoire_id, productive")
ORACLES["group_length"] = sql(_lengths("aa", "repertoire_group_id", "gl") + "\nSELECT * FROM h")
ORACLES["group_length_stats"] = sql(_lengths("aa", _K, "gl") + ",\n" + _stats("productive, length", "h", ["count"]))


def _distribution(kind: str, by: str = "repertoire_id", rows: str = "rr") -> str:
    column, letters = ("junction_aa", "ACDEFGHIKLMNPQRSTVWY") if kind == "aa" else ("junction", "ACGT")
    return f"""src AS (SELECT {by}, prod, {column} AS s FROM {rows} WHERE regexp_full_match({column}, '[ACDEFGHIKLMNPQRSTVWY]+')),
split AS (SELECT *, false AS productive FROM src UNION ALL SELECT *, true FROM src WHERE prod),
spelled AS (SELECT {by}, productive, cast(length(s) AS int) AS length, unnest(range(0, length(s))) AS p, s FROM split),
single AS (SELECT {by}, productive, length, cast(p AS int) AS position, substr(s, cast(p + 1 AS int), 1) AS letter FROM spelled),
places AS (SELECT DISTINCT {by}, productive, length, position FROM single),
cells AS (SELECT places.*, l.letter FROM places CROSS JOIN (SELECT unnest(string_split('{",".join(letters)}', ',')) AS letter) l),
found AS (SELECT {by}, productive, length, position, letter, count(*) AS c FROM single GROUP BY {by}, productive, length, position, letter),
dist AS (SELECT g.*, coalesce(f.c, 0) AS count FROM cells g LEFT JOIN found f ON {" AND ".join(f"g.{k} = f.{k}" for k in [*by.split(", "), "productive", "length", "position", "letter"])})"""


ORACLES["distribution_aa"] = sql(_distribution("aa") + "\nSELECT * FROM dist")
ORACLES["distribution_nt"] = sql(_distribution("nt") + "\nSELECT * FROM dist")
_t = "sum(count) OVER (PARTITION BY repertoire_id, productive, length, position)"
ORACLES["distribution_relative"] = sql(_distribution("nt") + f"\nSELECT *, CASE WHEN {_t} = 0 THEN 0 ELSE cast(count AS double) / {_t} END AS relative FROM dist")
ORACLES["group_distribution_aa"] = sql(_distribution("aa", "repertoire_group_id", "gr") + "\nSELECT * FROM dist")
ORACLES["group_distribution_stats"] = sql(_distribution("nt", _K, "gr") + ",\n" + _stats("productive, length, position, letter", "dist", ["count"]))

# -- sharing -------------------------------------------------------------------------------------


def _shares(*levels: str) -> str:
    parts = []
    for level in levels:
        genes, _, kind = level.rpartition(",")
        column = "junction_aa" if kind == "aa" else "junction"
        key = " || '|' || ".join(f"{g}.g" for g in genes) or "''"
        joins = "".join(f" JOIN first_gene {g} ON {g}.sequence_id = rr.sequence_id AND {g}.field = '{g}_call'" for g in genes)
        parts.append(f"SELECT '{level}' AS level, {key} AS gene_key, {column} AS cdr3, repertoire_id, w FROM rr{joins} WHERE prod AND {column} <> ''")
    return f"""first_gene AS (SELECT sequence_id, field, arg_min(name, p) AS g FROM named0 WHERE level = 'gene' GROUP BY sequence_id, field),
one AS ({' UNION ALL '.join(parts)}),
sh AS MATERIALIZED (SELECT level, gene_key, cdr3, repertoire_id, count(*) AS sequence_count, cast(sum(w) AS bigint) AS duplicate_count FROM one GROUP BY level, gene_key, cdr3, repertoire_id),
gs AS MATERIALIZED (SELECT level, gene_key, cdr3, m.repertoire_group_id, count(*) AS share_level, cast(sum(sequence_count) AS bigint) AS sequence_count, cast(sum(duplicate_count) AS bigint) AS duplicate_count FROM sh JOIN members m ON sh.repertoire_id = m.repertoire_id GROUP BY level, gene_key, cdr3, m.repertoire_group_id)"""


for _n, _l in (("aa", "aa"), ("nt", "nucleotide"), ("v_aa", "v,aa"), ("v_nt", "v,nucleotide"), ("vj_aa", "vj,aa"), ("vj_nt", "vj,nucleotide")):
    ORACLES[f"share_rep_{_n}"] = sql(_shares(_l) + "\nSELECT * FROM sh")
ORACLES["share_group_aa"] = sql(_shares("aa") + "\nSELECT * FROM gs")
ORACLES["share_level_detail"] = sql(_shares("v,aa") + "\nSELECT * FROM gs")
ORACLES["share_summary_group"] = sql(_shares("aa", "vj,aa") + "\nSELECT level, repertoire_group_id, share_level, count(*) AS n FROM gs GROUP BY level, repertoire_group_id, share_level")
ORACLES["share_summary_rep"] = sql(_shares("aa", "vj,aa") + "\nSELECT level, repertoire_id, count(*) AS n FROM sh GROUP BY level, repertoire_id")
ORACLES["share_group_detail"] = sql(_shares("aa") + """
SELECT m.repertoire_group_id, cdr3, string_agg(concat(sh.repertoire_id, ':', cast(sequence_count AS string), ':', cast(duplicate_count AS string)), ',' ORDER BY sh.repertoire_id) AS repertoires
FROM sh JOIN members m ON sh.repertoire_id = m.repertoire_id GROUP BY m.repertoire_group_id, cdr3""")


def _matrix(level: str, column: str) -> str:
    return sql(_shares(level) + f""",
ids AS (SELECT DISTINCT repertoire_id AS r FROM nation_members),
sets AS (SELECT repertoire_id, list(gene_key || '/' || cdr3) AS js FROM sh GROUP BY repertoire_id),
both_ AS (SELECT a.repertoire_id AS ra, b.repertoire_id AS rb, len(list_intersect(a.js, b.js)) AS n_shared, len(a.js) - len(list_intersect(a.js, b.js)) AS n_diff FROM sets a CROSS JOIN sets b)
SELECT '{level}' AS level, a.r AS repertoire_id_a, b.r AS repertoire_id_b, coalesce(x.{column}, {"0" if column == "n_shared" else "(SELECT len(js) FROM sets WHERE sets.repertoire_id = a.r), 0"}) AS {column}
FROM ids a CROSS JOIN ids b LEFT JOIN both_ x ON x.ra = a.r AND x.rb = b.r""", "nation_members")


ORACLES["share_matrix_shared"], ORACLES["share_matrix_shared_v"], ORACLES["share_matrix_diff"] = _matrix("aa", "n_shared"), _matrix("v,aa", "n_shared"), _matrix("aa", "n_diff")
_on = "a.level = b.level AND a.gene_key = b.gene_key AND a.cdr3 = b.cdr3"
_rep = "a.level, a.gene_key, a.cdr3, a.repertoire_id AS repertoire_id_a"
ORACLES["share_detail_shared"] = sql(_shares("vj,aa") + f"\nSELECT {_rep}, a.sequence_count AS sequence_count_a, a.duplicate_count AS duplicate_count_a, b.repertoire_id AS repertoire_id_b, b.sequence_count AS sequence_count_b, b.duplicate_count AS duplicate_count_b FROM sh a JOIN sh b ON {_on} AND a.repertoire_id <> b.repertoire_id")
ORACLES["share_detail_diff"] = sql(_shares("v,aa") + f""",
ids AS (SELECT DISTINCT level, gene_key, repertoire_id FROM sh)
SELECT {_rep}, i.repertoire_id AS repertoire_id_b, a.sequence_count AS sequence_count_a, a.duplicate_count AS duplicate_count_a FROM sh a JOIN ids i ON a.level = i.level AND a.gene_key = i.gene_key AND a.repertoire_id <> i.repertoire_id
WHERE NOT EXISTS (SELECT 1 FROM sh b WHERE {_on} AND b.repertoire_id = i.repertoire_id)""")
ORACLES["share_detail_diff_pairs"] = sql(_shares("aa") + f"""
SELECT {_rep}, p.b AS repertoire_id_b, a.sequence_count AS sequence_count_a, a.duplicate_count AS duplicate_count_a
FROM sh a JOIN (VALUES ('rep0', 'rep1'), ('rep1', 'rep0'), ('rep2', 'rep5'), ('rep3', 'rep20'), ('rep20', 'rep3')) p(a, b) ON a.repertoire_id = p.a WHERE (a.cdr3, p.b) NOT IN (SELECT cdr3, repertoire_id FROM sh)""")
_ga = "a.level, a.gene_key, a.cdr3, a.repertoire_group_id AS repertoire_group_id_a, a.share_level AS share_level_a, a.sequence_count AS sequence_count_a, a.duplicate_count AS duplicate_count_a"


def _compare(level: str) -> str:
    return sql(_shares(level) + f"\nSELECT {_ga}, b.repertoire_group_id AS repertoire_group_id_b, b.share_level AS share_level_b, b.sequence_count AS sequence_count_b, b.duplicate_count AS duplicate_count_b FROM gs a JOIN gs b ON {_on} AND a.repertoire_group_id <> b.repertoire_group_id")


def _differ(level: str) -> str:
    return sql(_shares(level) + f""",
ids AS (SELECT DISTINCT level, repertoire_group_id FROM gs)
SELECT {_ga}, i.repertoire_group_id AS repertoire_group_id_b FROM gs a JOIN ids i ON a.level = i.level AND a.repertoire_group_id <> i.repertoire_group_id
WHERE NOT EXISTS (SELECT 1 FROM gs b WHERE {_on} AND b.repertoire_group_id = i.repertoire_group_id)""")


ORACLES["group_share_compare"], ORACLES["group_share_compare_gene"] = _compare("aa"), _compare("v,aa")
ORACLES["group_share_compare_totals"] = sql(_shares("aa", "v,aa", "vj,nucleotide") + f"""
SELECT a.level, a.repertoire_group_id AS repertoire_group_id_a, b.repertoire_group_id AS repertoire_group_id_b, count(*) AS n, cast(sum(a.sequence_count) AS bigint) AS sequence_count_a, cast(sum(b.sequence_count) AS bigint) AS sequence_count_b,
  cast(sum(a.duplicate_count) AS bigint) AS duplicate_count_a, cast(sum(b.duplicate_count) AS bigint) AS duplicate_count_b
FROM gs a JOIN gs b ON {_on} AND a.repertoire_group_id <> b.repertoire_group_id GROUP BY a.level, a.repertoire_group_id, b.repertoire_group_id""")
ORACLES["group_share_diff_absent"] = sql(_shares("aa") + """,
nm AS (SELECT DISTINCT repertoire_group_id, repertoire_id FROM nation_members),
ng AS (SELECT cdr3, nm.repertoire_group_id AS g, count(*) AS share_level, cast(sum(duplicate_count) AS bigint) AS d FROM sh JOIN nm ON nm.repertoire_id = sh.repertoire_id GROUP BY cdr3, nm.repertoire_group_id)
SELECT 'aa' AS level, a.g AS repertoire_group_id_a, b.g AS repertoire_group_id_b, a.share_level AS share_level_a, count(*) AS n, cast(sum(a.d) AS bigint) AS duplicate_count_a
FROM ng a JOIN (SELECT DISTINCT repertoire_group_id AS g FROM nm) b ON a.g <> b.g WHERE NOT EXISTS (SELECT 1 FROM ng c WHERE c.g = b.g AND c.cdr3 = a.cdr3) GROUP BY a.g, b.g, a.share_level""", "nation_members")
ORACLES["group_share_diff"], ORACLES["group_share_diff_gene"] = _differ("aa"), _differ("v,aa")
ORACLES["group_share_matrix"] = sql(_shares("aa") + f""",
most AS (SELECT level, repertoire_group_id AS g, unnest(range(1, max(share_level) + 1)) AS sl FROM gs GROUP BY level, repertoire_group_id),
pairs AS (SELECT a.level, a.repertoire_group_id AS ga, b.repertoire_group_id AS gb, a.share_level AS la, b.share_level AS lb, count(*) AS n FROM gs a JOIN gs b ON {_on} GROUP BY ALL)
SELECT x.level, x.g AS repertoire_group_id_a, y.g AS repertoire_group_id_b, x.sl AS share_level_a, y.sl AS share_level_b, coalesce(p.n, 0) AS n FROM most x JOIN most y ON x.level = y.level AND x.g <> y.g
LEFT JOIN pairs p ON p.level = x.level AND p.ga = x.g AND p.gb = y.g AND p.la = x.sl AND p.lb = y.sl""")
ORACLES["share_set_intersect"] = sql(_shares("aa") + "\nSELECT cdr3 FROM sh WHERE repertoire_id = 'rep0' INTERSECT SELECT cdr3 FROM sh WHERE repertoire_id = 'rep1'")
ORACLES["share_set_except"] = sql(_shares("aa") + "\nSELECT cdr3 FROM sh WHERE repertoire_id = 'rep0' EXCEPT SELECT cdr3 FROM sh WHERE repertoire_id = 'rep1'")

# -- clones --------------------------------------------------------------------------------------


def _clones(level: str, dup: str = "arg_max(w, sequence_id)") -> str:
    names = "r.v_call AS v, r.j_call AS j" if level == "allele" else "coalesce(jv.names, '') AS v, coalesce(jj.names, '') AS j"
    joins = "" if level == "allele" else " LEFT JOIN joined jv ON jv.sequence_id = r.sequence_id AND jv.field = 'v_call' AND jv.level = 'gene' LEFT JOIN joined jj ON jj.sequence_id = r.sequence_id AND jj.field = 'j_call' AND jj.level = 'gene'"
    return f"""kr AS (SELECT r.sequence_id, r.repertoire_id, r.junction_aa, r.w, {names} FROM rr r{joins} WHERE contains(locus, 'TR') AND prod AND junction_aa <> ''),
cl0 AS (SELECT repertoire_id, junction_aa, v, j, count(*) AS clone_count, cast({dup} AS bigint) AS duplicate_count, min(sequence_id) AS first_ord FROM kr GROUP BY repertoire_id, junction_aa, v, j),
cl AS (SELECT *, row_number() OVER (PARTITION BY repertoire_id ORDER BY first_ord) AS clone_id FROM cl0)"""


_plain = "\nSELECT repertoire_id, junction_aa, v, j, clone_count, duplicate_count FROM cl"
ORACLES["clone_allele"], ORACLES["clone_gene"] = sql(_clones("allele") + _plain), sql(_clones("gene") + _plain)
ORACLES["clone_allele_sum"] = sql(_clones("allele", "sum(w)") + _plain)
ORACLES["clone_ids"] = sql(_clones("gene") + "\nSELECT * FROM cl")
ORACLES["clone_assign_rows"] = sql(_clones("allele") + "\nSELECT k.sequence_id, k.repertoire_id, c.clone_id FROM kr k JOIN cl c ON k.repertoire_id = c.repertoire_id AND k.junction_aa = c.junction_aa AND k.v = c.v AND k.j = c.j")

# each clone in its turn (largest weight first, ties by first appearance) joins the first seed it overlaps, or is a seed
ORACLES["clone_collapse"] = sql("RECURSIVE_" + _clones("allele") + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY repertoire_id, junction_aa ORDER BY duplicate_count DESC, first_ord, v, j) AS k FROM cl),
fold AS (SELECT repertoire_id, junction_aa, k, [{'i': first_ord, 'v': v, 'j': j, 'n': clone_count, 'd': duplicate_count}] AS seeds FROM ranked WHERE k = 1
  UNION ALL SELECT f.repertoire_id, f.junction_aa, c.k, CASE WHEN len(list_filter(f.seeds, lambda t: list_has_any(string_split(t.v, ','), string_split(c.v, ',')) AND list_has_any(string_split(t.j, ','), string_split(c.j, ',')))) = 0
    THEN list_append(f.seeds, {'i': c.first_ord, 'v': c.v, 'j': c.j, 'n': c.clone_count, 'd': c.duplicate_count})
    ELSE list_transform(f.seeds, lambda t, p: CASE WHEN p = list_position(list_transform(f.seeds, lambda u: list_has_any(string_split(u.v, ','), string_split(c.v, ',')) AND list_has_any(string_split(u.j, ','), string_split(c.j, ','))), true)
      THEN {'i': t.i, 'v': t.v, 'j': t.j, 'n': t.n + c.clone_count, 'd': t.d + c.duplicate_count} ELSE t END) END
  FROM fold f JOIN ranked c ON c.repertoire_id = f.repertoire_id AND c.junction_aa = f.junction_aa AND c.k = f.k + 1),
ended AS (SELECT repertoire_id, junction_aa, unnest(arg_max(seeds, k)) AS m FROM fold GROUP BY repertoire_id, junction_aa)
SELECT repertoire_id, junction_aa, m.v AS v, m.j AS j, m.n AS clone_count, m.d AS duplicate_count, m.i AS first_ord FROM ended""")
ORACLES["clone_collapse"] = ORACLES["clone_collapse"].replace("RECURSIVE_", "").replace("WITH ", "WITH RECURSIVE ", 1)

# -- mutations -----------------------------------------------------------------------------------

_REGIONS = ("fwr1", "cdr1", "fwr2", "cdr2", "fwr3")


def _codons(r: str) -> str:
    s = f"replace({r}, '-', '.')"
    return f"cast(len(list_filter(list_transform(range(0, cast(floor(length({r}) / 3) AS int)), lambda i: substr({s}, cast(3 * i + 1 AS int), 3)), lambda c: c <> '...')) AS int)"


_region_cols = ", ".join(f"cast(length(replace(replace({r}, '-', ''), '.', '')) AS int) AS mu_total_count_{r}, {_codons(r)} AS mu_total_count_{r}_aa" for r in _REGIONS)
_counts = "cast(sum(r) AS bigint) AS r, cast(sum(s) AS bigint) AS s, cast(sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) AS bigint) AS r_aa, cast(sum(CASE WHEN s > 0 THEN 1 ELSE 0 END) AS bigint) AS s_aa"
ORACLES["mutation_region_lengths"] = with_views(f"SELECT sequence_id, {_region_cols} FROM regions", "regions")
_table = ", ".join(f"('{c}', '{a}')" for c, a in codon_table().items())
_letters = " UNION ALL ".join(f"SELECT sequence_id, '{r}' AS region, unnest(range(0, cast(floor(length({r}) / 3) AS int))) AS i, replace({r}, '-', '.') AS s FROM regions" for r in _REGIONS)
_spelled = ", ".join(f"coalesce(max(CASE WHEN region = '{r}' THEN word END), '') AS {r}_aa" for r in _REGIONS)
ORACLES["mutation_translate"] = with_views(f"""WITH code AS (SELECT * FROM (VALUES {_table}) t(codon, letter)),
cells AS (SELECT sequence_id, region, i, upper(substr(s, cast(3 * i + 1 AS int), 3)) AS c FROM ({_letters})),
words AS (SELECT sequence_id, region, string_agg(CASE WHEN c = '...' THEN '.' ELSE coalesce(letter, 'X') END, '' ORDER BY i) AS word FROM cells LEFT JOIN code ON replace(c, '.', 'N') = codon GROUP BY sequence_id, region)
SELECT r.sequence_id, {_spelled} FROM regions r LEFT JOIN words w ON r.sequence_id = w.sequence_id GROUP BY r.sequence_id""", "regions")
ORACLES["mutation_row_counts"] = with_views(f"SELECT sequence_id, {_counts} FROM mutation_positions GROUP BY sequence_id", "mutation_positions")
ORACLES["mutation_row_region_counts"] = with_views(f"SELECT sequence_id, region, {_counts} FROM mutation_positions GROUP BY sequence_id, region", "mutation_positions")
_row_counts = ", ".join(f"cast(sum(CASE WHEN {w} THEN {x} ELSE 0 END) AS bigint) AS mu_count{t}_{c}" for t, w in (("", "true"), *((f"_{r}", f"region = '{r}'") for r in _REGIONS))
                        for c, x in (("r", "r"), ("s", "s"), ("r_aa", "(CASE WHEN r > 0 THEN 1 ELSE 0 END)"), ("s_aa", "(CASE WHEN s > 0 THEN 1 ELSE 0 END)")))
ORACLES["mutation_rows"] = with_views(f"""WITH code AS (SELECT * FROM (VALUES {_table}) t(codon, letter)),
cells AS (SELECT sequence_id, region, i, upper(substr(s, cast(3 * i + 1 AS int), 3)) AS c FROM ({_letters})),
words AS (SELECT sequence_id, region, string_agg(CASE WHEN c = '...' THEN '.' ELSE coalesce(letter, 'X') END, '' ORDER BY i) AS word FROM cells LEFT JOIN code ON replace(c, '.', 'N') = codon GROUP BY sequence_id, region),
a AS (SELECT r.sequence_id, {_spelled} FROM regions r LEFT JOIN words w ON r.sequence_id = w.sequence_id GROUP BY r.sequence_id),
c AS (SELECT sequence_id, {_row_counts} FROM mutation_positions GROUP BY sequence_id), l AS (SELECT sequence_id, {_region_cols} FROM regions)
SELECT x.repertoire_id, x.v_call, l.*, a.* EXCLUDE (sequence_id), c.* EXCLUDE (sequence_id) FROM rearrangements x JOIN l ON x.sequence_id = l.sequence_id JOIN a ON a.sequence_id = x.sequence_id JOIN c ON c.sequence_id = x.sequence_id""", "mutation_positions", "rearrangements", "regions")


_SUMS = ", ".join(f"cast(sum({c}) AS bigint) AS {c}" for c in ("r", "s", "r_aa", "s_aa", "total", "total_aa"))


def _weighted(by: str, rows: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""keyed AS ({rows}),
bp AS (SELECT {keys}pos, region, region_class, cast(sum(r * w) AS bigint) AS r, cast(sum(s * w) AS bigint) AS s, cast(sum(CASE WHEN r > 0 THEN w ELSE 0 END) AS bigint) AS r_aa, cast(sum(CASE WHEN s > 0 THEN w ELSE 0 END) AS bigint) AS s_aa,
  cast(3 * sum(CASE WHEN mutable THEN w ELSE 0 END) AS bigint) AS total, cast(sum(CASE WHEN mutable THEN w ELSE 0 END) AS bigint) AS total_aa FROM mutation_positions p JOIN keyed k ON p.sequence_id = k.sequence_id GROUP BY {keys}pos, region, region_class),
ru AS ({" UNION ALL ".join(f"SELECT {keys}'{scope}' AS scope, {part} AS part, {_SUMS} FROM bp GROUP BY {keys}{part if scope != 'global' else '1'}" if by or scope != 'global' else f"SELECT '{scope}' AS scope, {part} AS part, {_SUMS} FROM bp" for scope, part in (("position", "cast(pos AS string)"), ("region", "region"), ("class", "region_class"), ("global", "'all'")))})"""




def _mutation(by: str, rows: str, final: str) -> str:
    text = _weighted(by, rows)
    if by:  # group the whole by its keys alone
        text = text.replace(f"GROUP BY {by}, 1", f"GROUP BY {by}")
    return sql(text + "\n" + final, "mutation_positions")


_rows_rep = "SELECT sequence_id, repertoire_id, w FROM rr"
_rows_clone = "SELECT sequence_id, repertoire_id, clone_id, w FROM rr WHERE clone_id IS NOT NULL"
_all = "SELECT {}, scope, part, r, s, r_aa, s_aa, total, total_aa FROM ru WHERE {}"
ORACLES["mutation_pos_counts"] = _mutation("repertoire_id", _rows_rep, "SELECT * FROM bp")
ORACLES["mutation_rep_counts"] = _mutation("repertoire_id", _rows_rep, _all.format("repertoire_id", "true"))
ORACLES["mutation_totals"] = _mutation("", "SELECT sequence_id, w FROM rr", "SELECT scope, part, total, total_aa FROM ru")
ORACLES["mutation_region_counts"] = _mutation("repertoire_id", _rows_rep, _all.format("repertoire_id", "scope = 'region'"))
ORACLES["mutation_clone_counts"] = _mutation("repertoire_id, clone_id", _rows_clone, _all.format("repertoire_id, clone_id", "scope <> 'position'"))
for _s in "vj":
    for _n, _l in (("call", "allele"), ("gene", "gene"), ("subgroup", "subgroup")):
        _rows = f"SELECT rr.sequence_id, repertoire_id, j.names AS segment, w FROM rr JOIN joined j ON j.sequence_id = rr.sequence_id AND j.field = '{_s}_call' AND j.level = '{_l}'"
        ORACLES[f"mutation_{_s}_{_n}_counts"] = _mutation("repertoire_id, segment", _rows, _all.format("repertoire_id, segment", "scope <> 'position'"))
ORACLES["mutation_group_rep_counts"] = _mutation(_K, f"SELECT sequence_id, {_K}, w FROM gr", _all.format(_K, "scope <> 'position'"))
ORACLES["mutation_sequence_totals"] = sql("SELECT repertoire_id, count(*) AS mu_seq_count, cast(sum(w) AS bigint) AS mu_duplicate_count FROM rr WHERE sequence_id IN (SELECT sequence_id FROM regions) GROUP BY repertoire_id", "regions")
ORACLES["mutation_unique_positions"] = _mutation("repertoire_id", _rows_rep, "SELECT repertoire_id, cast(sum(CASE WHEN r_aa > 0 THEN 1 ELSE 0 END) AS bigint) AS mu_unique_r, cast(sum(CASE WHEN s_aa > 0 THEN 1 ELSE 0 END) AS bigint) AS mu_unique_s FROM bp GROUP BY repertoire_id")


def _f(n: str, t: str) -> str:
    return f"(CASE WHEN {t} = 0 THEN cast(0 AS double) ELSE cast({n} AS double) / {t} END)"


_freqs = {f"freq{k}{x}": (f"{_f('r' + x, 'total' + x)} + {_f('s' + x, 'total' + x)}" if not k else _f(k[1:] + x, "total" + x)) for x in ("", "_aa") for k in ("_r", "_s", "")}
_freq_cols = ", ".join(f"{e} AS {c}" for c, e in _freqs.items())
for _n, _w in (("global", "scope = 'global'"), ("region", "scope IN ('region', 'class')"), ("pos", "scope = 'position'")):
    ORACLES[f"mutation_freq_{_n}"] = _mutation("repertoire_id", _rows_rep, f"SELECT repertoire_id, scope, part, {_freq_cols} FROM ru WHERE {_w}")


def _ratio(x: str) -> dict[str, str]:
    rs = f"CASE WHEN c.r{x} = 0 AND c.s{x} = 0 THEN cast('NaN' AS double) WHEN c.s{x} = 0 THEN cast('Infinity' AS double) ELSE cast(c.r{x} AS double) / c.s{x} END"
    return {f"ratio{x}": _f(f"(c.r{x} + c.s{x})", f"(g.r{x} + g.s{x})"), f"ratio_r{x}": _f(f"c.r{x}", f"g.r{x}"), f"ratio_s{x}": _f(f"c.s{x}", f"g.s{x}"), f"rsratio{x}": rs}


_ratios = {**_ratio(""), **_ratio("_aa")}


def _ratio_rows(by: str, names: list[str]) -> str:
    on = " AND ".join(f"c.{k} = g.{k}" for k in by.split(", "))
    cols = ", ".join(f"{_ratios[n]} AS {n}" for n in names)
    return f"SELECT {', '.join('c.' + k for k in by.split(', '))}, c.part AS region_class, {cols} FROM ru c JOIN ru g ON {on} AND g.scope = 'global' WHERE c.scope = 'class'"


ORACLES["mutation_region_ratio"] = _mutation("repertoire_id", _rows_rep, _ratio_rows("repertoire_id", [n for n in _ratios if not n.startswith("rs")]))
ORACLES["mutation_rs_ratio"] = _mutation("repertoire_id, clone_id", _rows_clone, _ratio_rows("repertoire_id, clone_id", ["rsratio", "rsratio_aa"]))
_group_ru = _weighted(_K, f"SELECT sequence_id, {_K}, w FROM gr").replace(f"GROUP BY {_K}, 1", f"GROUP BY {_K}")
_long = " UNION ALL ".join(f"SELECT {_K}, scope, part, '{c}' AS field, {e} AS value, {'total_aa' if c.endswith('_aa') else 'total'} AS n FROM ru" for c, e in _freqs.items())
_avg, _std = _moments("l", "len(l)")
_statistics = f"len(l) AS N, CASE WHEN len(l) = 0 THEN 0 ELSE {_avg} END AS avg, {_std} AS std"
_group_freq = _group_ru + f""",
lf AS ({_long}),
gl_f AS (SELECT repertoire_group_id, scope, part, field, coalesce(list(value ORDER BY repertoire_id) FILTER (WHERE n > 0), []) AS l FROM lf GROUP BY repertoire_group_id, scope, part, field),
gf AS (SELECT repertoire_group_id, scope, part, field, {_statistics} FROM gl_f)"""
_long = " UNION ALL ".join(f"SELECT {_K}, region_class, '{c}' AS field, {c} AS value FROM rt" for c in _ratios)
_group_ratio = f""",
rt AS ({_ratio_rows(_K, list(_ratios))}),
lr AS ({_long}),
gl_t AS (SELECT repertoire_group_id, region_class, field, list(value ORDER BY repertoire_id) AS l FROM lr GROUP BY repertoire_group_id, region_class, field),
gt AS (SELECT repertoire_group_id, region_class, field, {_statistics} FROM gl_t)"""
ORACLES["mutation_group_freq_stats"] = sql(f"{_group_freq}\nSELECT repertoire_group_id, scope, part, field, N, avg, std FROM gf", "mutation_positions")
ORACLES["mutation_group_ratio_stats"] = sql(f"{_group_ru}{_group_ratio}\nSELECT repertoire_group_id, region_class, field, N, avg, std FROM gt", "mutation_positions")


def _wide_group() -> str:
    """A column per frequency or ratio and statistic, by the names that the report gives them."""
    heads, cells = ("avg", "std", "N"), []
    places = [("all", "")] + [(p, f"_{p}") for p in ("fwr", "cdr", *_REGIONS)]
    wanted = [(p, f) for p in places for f in _freqs] + [((str(p), f"_{p}"), f) for p in range(1, 105) for f in _freqs if f.startswith(("freq_r", "freq_s"))]
    for (part, middle), f in wanted:
        cells += [f"max(CASE WHEN part = '{part}' AND field = '{f}' THEN {_cell(h)} END) AS mu_freq{middle}{f[4:]}_{h}" for h in heads]
    for c in ("fwr", "cdr"):
        for f in _ratios:
            head = "rsratio" if f.startswith("rs") else "ratio"
            cells += [f"max(CASE WHEN part = '{c}' AND field = '{f}' THEN {_cell(h)} END) AS mu_{head}_{c}{f[len(head):]}_{h}" for h in heads]
    return f"""{_group_freq}{_group_ratio},
every AS (SELECT repertoire_group_id, part, field, N, avg, std FROM gf UNION ALL SELECT repertoire_group_id, region_class, field, N, avg, std FROM gt)
SELECT repertoire_group_id, (SELECT count(*) FROM ru WHERE scope = 'global' AND ru.repertoire_group_id = every.repertoire_group_id) AS N, {", ".join(cells)} FROM every GROUP BY repertoire_group_id"""


def _cell(statistic: str) -> str:
    return "cast(N AS double)" if statistic == "N" else statistic


ORACLES["mutation_group_wide"] = sql(_wide_group(), "mutation_positions")
