"""SQL of the linkage queries for DuckDB, built from shared common table expressions."""

from __future__ import annotations

from tessera.functions.text import ADDRESS_DROPPED, ADDRESS_WORDS, NAME_WORDS

# In the order in which one builds on another.
_PARTS: dict[str, str] = {}


def _cases(table: dict[str, str], token: str) -> str:
    return f"CASE {token} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {token} END"


def _tokens(column: str) -> str:
    folded = f"lower(regexp_replace(strip_accents({column}), '[^\\x00-\\x7F]', '', 'g'))"
    spaced = f"regexp_replace({folded}, '[^a-z0-9_\\s]', ' ', 'g')"
    return f"list_filter(string_split_regex({spaced}, '\\s+'), lambda t: t <> '')"


_DROPPED = ", ".join(f"'{w}'" for w in ADDRESS_DROPPED)
_PARTS["doc"] = """SELECT concat('S', doc_id % 3 + 1, '-', doc_id) AS entity_id, concat('S', doc_id % 3 + 1) AS source, coalesce(text, '') AS business_name,
    coalesce(text, '') AS business_address, coalesce(lang, '') AS country FROM documents WHERE doc_id IS NOT NULL"""
_PARTS["cust"] = "SELECT c_custkey::BIGINT AS k, *, CASE WHEN c_acctbal < 0 THEN '' ELSE n_name END AS place FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_PARTS["supp"] = "SELECT s_suppkey::BIGINT AS k, *, CASE WHEN s_acctbal < 0 THEN '' ELSE n_name END AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_PARTS["rec"] = """SELECT concat('S1-', k * 10 + 1) AS entity_id, 'S1' AS source, c_name AS business_name, concat_ws(' ', n_name, r_name, c_mktsegment) AS business_address, place AS country, concat('c', k) AS who FROM cust
  UNION ALL SELECT concat('S1-', k * 10 + 2), 'S1', s_name, concat_ws(' ', n_name, r_name), place, concat('s', k) FROM supp
  UNION ALL SELECT concat('S1-', p_partkey::BIGINT * 10 + 3), 'S1', p_name, concat_ws(' ', p_brand, p_type, 'no.', p_size), '', concat('p', p_partkey) FROM part
  UNION ALL SELECT concat('S2-', k), 'S2', concat_ws(' ', 'Supp.', k, 'Intl'), concat('No. ', k, ', ', n_name, ' Rd'), lower(place), concat('s', k) FROM supp
  UNION ALL SELECT concat('S3-', k), 'S3', concat_ws(' ', replace(c_name, '#', ' '), 'Co'), concat_ws(' ', c_mktsegment, n_name, 'Sq'), lower(place), concat('c', k) FROM cust"""


def _normal(rows: str) -> str:
    return f"""SELECT *, array_to_string(list_transform({_tokens("business_name")}, lambda t: {_cases(NAME_WORDS, "t")}), ' ') AS norm_name,
    array_to_string(list_filter(list_transform({_tokens("business_address")}, lambda t: {_cases(ADDRESS_WORDS, "t")}), lambda t: t NOT IN ({_DROPPED})), ' ') AS norm_address
  FROM {rows}"""


_PARTS["docn"] = _normal("doc")
_PARTS["norm"] = _normal("rec")
_PARTS["ents"] = "SELECT entity_id AS s1_id FROM rec WHERE source = 'S1'"
_PARTS["truth"] = "SELECT a.entity_id AS s1_id, b.entity_id AS cand_id FROM rec a JOIN rec b USING (who) WHERE a.source = 'S1' AND b.source <> 'S1'"
_PARTS["words"] = """SELECT entity_id, source, country, field, unnest(list_filter(string_split(x, ' '), lambda t: t <> '')) AS w FROM (
    SELECT entity_id, source, lower(country) AS country, 'name' AS field, norm_name AS x FROM norm UNION ALL
    SELECT entity_id, source, lower(country), 'address', norm_address FROM norm)"""
_PARTS["tf"] = """SELECT entity_id, source, country, field, gram, count(*) AS tf FROM (
    SELECT entity_id, source, country, field, unnest(list_concat(list_transform(range(1, length(w) + 2), lambda i: substr(' ' || w || ' ', i, 2)),
      list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3)))) AS gram FROM words) GROUP BY ALL"""
_PARTS["vocab"] = "SELECT field, gram, count(*) AS df, ln((1.0 + (SELECT count(*) FROM rec)) / (1.0 + count(*))) + 1 AS idf FROM tf GROUP BY field, gram"
_PARTS["raw"] = "SELECT tf.*, (1 + ln(tf)) * idf AS raw FROM tf JOIN vocab USING (field, gram)"
_PARTS["post"] = "SELECT entity_id, source, country, field, gram, raw / sqrt(sum(raw * raw) OVER (PARTITION BY entity_id, source, field)) AS w FROM raw"
_PARTS["cos"] = """SELECT a.entity_id AS s1_id, b.entity_id AS cand_id, b.source, a.field, sum(a.w * b.w) AS score FROM post a JOIN post b USING (country, field, gram)
  WHERE a.source = 'S1' AND b.source <> 'S1' GROUP BY ALL HAVING sum(a.w * b.w) >= 0.05"""
_PARTS["top"] = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, source, field ORDER BY round(score, 9) DESC, cand_id) AS rank FROM cos) WHERE rank <= 10"
_PARTS["fuse"] = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY round(score, 9) DESC, cand_id) AS rank FROM (
    SELECT s1_id, cand_id, source, sum(CASE WHEN field = 'name' THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END * score) AS score FROM top GROUP BY ALL) WHERE round(score, 9) >= 0.05) WHERE rank <= 10"""
_PARTS["known"] = "SELECT s1_id, cand_id, score FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY round(score, 9) DESC, cand_id) AS n FROM fuse) WHERE n <= 30"
_PARTS["meas"] = """SELECT k.s1_id, k.cand_id, a.norm_name AS an, b.norm_name AS bn, a.norm_address AS aa, b.norm_address AS ba, a.country AS ac, b.country AS bc
  FROM known k JOIN norm a ON a.entity_id = k.s1_id JOIN norm b ON b.entity_id = k.cand_id"""
_SET = "list_distinct(list_filter(string_split({0}, ' '), lambda t: t <> ''))"


def _both(a: str, b: str, value: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE {value} END"


def _jaccard(a: str, b: str) -> str:
    x, y = _SET.format(a), _SET.format(b)
    return _both(a, b, f"len(list_intersect({x}, {y}))::DOUBLE / len(list_distinct(list_concat({x}, {y})))")


_PARTS["score"] = f"SELECT s1_id, cand_id, round({_jaccard('an', 'bn')} * 0.9::DOUBLE + 0.0533::DOUBLE, 6) AS proba FROM meas"
_PARTS["lab"] = "SELECT k.s1_id, k.cand_id, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM known k LEFT JOIN (SELECT DISTINCT * FROM truth) t USING (s1_id, cand_id)"
_PARTS["said"] = "SELECT s1_id, cand_id FROM score WHERE proba >= 0.5"
_PARTS["cnt"] = """SELECT e.s1_id, count(t.cand_id) FILTER (WHERE p.cand_id IS NOT NULL) AS tp, (SELECT count(*) FROM said s WHERE s.s1_id = e.s1_id) AS pp, count(t.cand_id) AS rp
  FROM ents e LEFT JOIN (SELECT DISTINCT * FROM truth) t USING (s1_id) LEFT JOIN said p ON p.s1_id = t.s1_id AND p.cand_id = t.cand_id GROUP BY e.s1_id"""
_P = "CASE WHEN pp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / pp END"
_R = "CASE WHEN rp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / rp END"
_F = "CASE WHEN tp = 0 THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * tp / (pp + 0.25::DOUBLE * rp) END"
_ONE = "CASE WHEN pp = 0 AND rp = 0 THEN 1.0::DOUBLE ELSE {0} END"
_PARTS["each"] = f"SELECT *, {_P} AS precision, {_R} AS recall, {_ONE.format(_F)} AS f05 FROM cnt"
_PARTS["grid"] = "SELECT 0.1::DOUBLE + i * ((0.1::DOUBLE + 0.01::DOUBLE) - 0.1::DOUBLE) AS threshold FROM range(81) r(i)"
_PARTS["gcnt"] = """SELECT g.threshold, e.s1_id, count(s.cand_id) AS pp, count(t.cand_id) AS tp, any_value(coalesce(n.rp, 0)) AS rp FROM grid g CROSS JOIN ents e
  LEFT JOIN score s ON s.s1_id = e.s1_id AND s.proba >= g.threshold LEFT JOIN (SELECT DISTINCT * FROM truth) t ON t.s1_id = s.s1_id AND t.cand_id = s.cand_id
  LEFT JOIN (SELECT s1_id, count(DISTINCT cand_id) AS rp FROM truth GROUP BY s1_id) n ON n.s1_id = e.s1_id GROUP BY g.threshold, e.s1_id"""
_MEANS = f"avg({_ONE.format(_P)}) AS precision, avg({_ONE.format(_R)}) AS recall, avg({_ONE.format(_F)}) AS f05"
_F1 = "CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE 2 * precision * recall / (precision + recall) END AS f1"
_PARTS["curve"] = f"SELECT *, {_F1} FROM (SELECT threshold, {_MEANS} FROM gcnt GROUP BY threshold)"


def _ratio(a: str, b: str) -> str:
    """2 LCS / lengths by one bit for each character of ``a``, a column of at most 61 characters."""
    places = f"list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN substr({a}, i, 1) = c THEN 1::BIGINT << (i - 1)::INTEGER ELSE 0::BIGINT END))::BIGINT"
    full = f"((1::BIGINT << length({a})::INTEGER) - 1)"
    row = f"list_reduce(list_concat([{full}], list_transform(string_split({b}, ''), lambda c: {places})), lambda row, m: ((row + (row & m)) | (row - (row & m))) & {full})"
    return _both(a, b, f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * (length({a}) - bit_count({row})) / (length({a}) + length({b})) END")


_SORTED = "array_to_string(list_sort(list_filter(string_split({0}, ' '), lambda t: t <> '')), ' ')"
_PARTS["sorted"] = f"SELECT s1_id, cand_id, {_SORTED.format('an')} AS sa, {_SORTED.format('bn')} AS sb FROM meas"
_PARTS["sets"] = f"""SELECT *, trim(concat_ws(' ', common, l)) AS one, trim(concat_ws(' ', common, r)) AS two FROM (SELECT s1_id, cand_id, an, bn, array_to_string(list_sort(list_intersect(x, y)), ' ') AS common,
    array_to_string(list_sort(list_filter(x, lambda t: NOT list_contains(y, t))), ' ') AS l, array_to_string(list_sort(list_filter(y, lambda t: NOT list_contains(x, t))), ' ') AS r
  FROM (SELECT *, {_SET.format("an")} AS x, {_SET.format("bn")} AS y FROM meas))"""


def _sql(select: str) -> str:
    """``select`` with the expressions that it builds on."""
    needed: set[str] = set()

    def need(sql: str) -> None:
        import re

        for word in set(re.findall(r"\b[a-z]\w*\b", sql)) & _PARTS.keys():
            if word not in needed and re.search(rf"(FROM|JOIN)\s+{word}\b", sql):
                needed.add(word)
                need(_PARTS[word])

    need(select)
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in _PARTS.items() if k in needed) + "\n" + select if needed else select


def _pairs(name: str, value: str) -> str:
    return f"SELECT s1_id, cand_id, round({value}, 6) AS {name} FROM meas"


def _rounded(columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())


_NUMBERS = "list_distinct(regexp_extract_all({0}, '\\b\\d+\\b'))"
_NA, _NB = _NUMBERS.format("aa"), _NUMBERS.format("ba")
_PLACE = "split_part({0}, '-', 2)::BIGINT * 2654435761 % 4294967296"
_LISTS = "SELECT e.s1_id AS source1_entity_id, coalesce((SELECT string_agg(DISTINCT cand_id, ',' ORDER BY cand_id) FROM ({0}) x WHERE x.s1_id = e.s1_id), '') AS {1} FROM ents e"
_MATCHED = _LISTS.format("SELECT * FROM said", "matched_entity_ids")


def _column_profile() -> str:
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    parts = [f"SELECT '{c}' AS \"column\", '{t}' AS type, count(DISTINCT {c}) AS n_distinct, count(*) - count({c}) AS n_null, round(100.0 * (count(*) - count({c})) / greatest(count(*), 1), 2) AS null_pct, round(count(DISTINCT {c})::DOUBLE / greatest(count(*), 1), 6) AS uniqueness FROM documents" for c, t in kinds.items()]
    return " UNION ALL ".join(parts)


def _describe() -> str:
    q = ", ".join(f"round(quantile_cont({{0}}::DOUBLE, {p}), 4) AS q{n}" for p, n in ((0.25, 25), (0.5, 50), (0.75, 75)))
    one = "SELECT '{0}' AS \"column\", count({0}) AS n, round(avg({0}), 4) AS mean, round(stddev_samp({0}), 4) AS std, round(min({0})::DOUBLE, 4) AS low, " + q + ", round(max({0})::DOUBLE, 4) AS high FROM lineitem"
    return " UNION ALL ".join(one.format(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))


def _summary() -> str:
    columns = {
        "benchmark": "item_id text", "conversations": "conv_id turn role text", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "documents": "doc_id text lang source n_chars",
        "events": "event_id ts user_id event_type value props", "labels": "doc_id quality toxic", "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
        "nation": "n_nationkey n_name n_regionkey", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority", "pages": "page_id url html", "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
        "region": "r_regionkey r_name", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    }
    out = []
    for name, names in columns.items():
        k = len(names.split())
        missing = " + ".join(f"(count(*) - count({c}))" for c in names.split())
        out.append(f"SELECT '{name}' AS \"table\", count(*) AS n_rows, {k}::BIGINT AS n_columns, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name})) AS n_duplicates, ({missing})::BIGINT AS missing_cells, round(100.0 * ({missing}) / greatest(count(*) * {k}, 1), 2) AS missing_pct FROM {name}")
    return " UNION ALL ".join(out)


_LENGTHS = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg(length({c})), 6) AS mean, quantile_cont(length({c})::DOUBLE, 0.5) AS median, min(length({c})) AS low, max(length({c})) AS high FROM doc" for c in ("business_name", "business_address", "country"))
_HISTOGRAM = """WITH s AS (SELECT length(coalesce(text, '')) AS size FROM documents), k AS (SELECT size FROM s WHERE size <= (SELECT quantile_cont(size::DOUBLE, 0.99) FROM s)),
  e AS (SELECT min(size) AS low, max(size) AS high FROM k)
SELECT CASE WHEN high = low THEN 0 ELSE least(floor((size - low) * 50.0 / (high - low)), 49) END::INTEGER AS bin, count(*) AS n FROM k, e GROUP BY 1"""

SQL: dict[str, str] = {
    name: _sql(select)
    for name, select in {
        "normalize_name": "SELECT entity_id, norm_name FROM docn",
        "normalize_address": "SELECT entity_id, norm_address FROM docn",
        "name_tokens": "SELECT entity_id, array_to_string(list_filter(string_split(norm_name, ' '), lambda t: length(t) > 1), '|') AS tokens FROM docn",
        "address_tokens": "SELECT entity_id, array_to_string(list_filter(string_split(norm_address, ' '), lambda t: length(t) > 1), '|') AS tokens FROM docn",
        "number_tokens": "SELECT event_id, coalesce((SELECT string_agg(v, '|' ORDER BY first) FROM (SELECT v, min(i) AS first FROM (SELECT unnest(n) AS v, generate_subscripts(n, 1) AS i FROM (SELECT regexp_extract_all(coalesce(props, ''), '\\b\\d+\\b') AS n)) GROUP BY v)), '') AS numbers FROM events",
        "combined_text": "SELECT entity_id, norm_name || ' ' || norm_address AS both FROM docn",
        "country_index": "SELECT lower(country) AS country, source, count(*) AS n FROM doc GROUP BY ALL",
        "char_ngrams": "SELECT entity_id, gram, count(*) AS tf FROM (SELECT entity_id, unnest(list_concat(list_transform(range(1, length(w) + 2), lambda i: substr(' ' || w || ' ', i, 2)), list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3)))) AS gram FROM (SELECT entity_id, unnest(list_filter(string_split(norm_name, ' '), lambda t: t <> '')) AS w FROM docn)) GROUP BY ALL",
        "gram_idf": "SELECT field, gram, df, round(idf, 6) AS idf FROM vocab",
        "tfidf_weights": "SELECT entity_id, field, gram, round(w, 6) AS w FROM post",
        "combined_weights": "SELECT entity_id, field, gram, round(v / sqrt(sum(v * v) OVER (PARTITION BY entity_id)), 6) AS w FROM (SELECT *, w * CASE WHEN field = 'name' THEN 0.6::DOUBLE ELSE 0.4::DOUBLE END AS v FROM post)",
        "topk_name": "SELECT s1_id, cand_id, source, rank::INTEGER AS rank, round(score, 6) AS score FROM top WHERE field = 'name'",
        "topk_address": "SELECT s1_id, cand_id, source, rank::INTEGER AS rank, round(score, 6) AS score FROM top WHERE field = 'address'",
        "fused_candidates": "SELECT s1_id, cand_id, source, rank::INTEGER AS rank, round(score, 6) AS score FROM fuse",
        "capped_candidates": "SELECT s1_id, cand_id, round(score, 6) AS score FROM known",
        "candidate_lists": _LISTS.format("SELECT * FROM top WHERE field = 'name'", "candidate_entity_ids"),
        "lists_to_pairs": "SELECT DISTINCT s1_id, cand_id FROM truth",
        "blocking_stats": """SELECT round(count(f.cand_id)::DOUBLE / greatest(count(*), 1), 4) AS recall_ceiling, round((SELECT count(*) FROM fuse)::DOUBLE / greatest((SELECT count(*) FROM ents), 1), 2) AS avg_candidates,
  (SELECT count(*) FROM fuse) AS total_pairs, count(f.cand_id) AS covered, count(*) AS total_true,
  round(1 - (SELECT count(*) FROM fuse)::DOUBLE / (SELECT count(*) FROM rec a JOIN rec b ON lower(a.country) = lower(b.country) WHERE a.source = 'S1' AND b.source <> 'S1'), 6) AS reduction_ratio FROM truth t LEFT JOIN fuse f ON f.s1_id = t.s1_id AND f.cand_id = t.cand_id""",
        "token_jaccard": _pairs("token_jaccard", _jaccard("an", "bn")),
        "token_overlap": _pairs("token_overlap", _both("an", "bn", f"len(list_intersect({_SET.format('an')}, {_SET.format('bn')}))::DOUBLE")),
        "address_token_jaccard": _pairs("token_jaccard", _jaccard("aa", "ba")),
        "lev_sim": _pairs("lev_sim", _both("an", "bn", "1 - levenshtein(an, bn)::DOUBLE / greatest(length(an), length(bn))")),
        "len_diff": _pairs("len_diff", "CASE WHEN greatest(length(aa), length(ba)) = 0 THEN 0.0::DOUBLE ELSE abs(length(aa) - length(ba))::DOUBLE / greatest(length(aa), length(ba)) END"),
        "common_numbers": _pairs("common_numbers", _both("aa", "ba", f"CASE WHEN len({_NA}) = 0 AND len({_NB}) = 0 THEN 1.0::DOUBLE WHEN len({_NA}) = 0 OR len({_NB}) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({_NA}, {_NB}))::DOUBLE / len(list_distinct(list_concat({_NA}, {_NB}))) END")),
        "one_empty": _pairs("one_empty", "((aa = '') <> (ba = ''))::INTEGER::DOUBLE"),
        "country_match": "SELECT s1_id, cand_id, CASE WHEN ac = '' OR bc = '' THEN 0.0::DOUBLE ELSE (lower(trim(ac)) = lower(trim(bc)))::INTEGER::DOUBLE END AS country_match FROM meas",
        "sorted_names": "SELECT entity_id, array_to_string(list_sort(list_filter(string_split(norm_name, ' '), lambda t: t <> '')), ' ') AS sorted_name FROM docn",
        "jaro_winkler": _pairs("jaro_winkler", _both("an", "bn", "jaro_winkler_similarity(an, bn)")),
        "ratio": _pairs("ratio", _ratio("an", "bn")),
        "token_sort": f"SELECT s1_id, cand_id, round({_ratio('sa', 'sb')}, 6) AS token_sort FROM sorted",
        "token_set": f"SELECT s1_id, cand_id, round(CASE WHEN an = '' OR bn = '' THEN 0.0::DOUBLE WHEN common <> '' AND (l = '' OR r = '') THEN 1.0::DOUBLE WHEN common = '' THEN {_ratio('one', 'two')} ELSE greatest({_ratio('one', 'two')}, {_ratio('common', 'one')}, {_ratio('common', 'two')}) END, 6) AS token_set FROM sets",
        "vector_cosine": "SELECT a.vec_id, round(coalesce(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 0), 6) AS cosine FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id IS NOT NULL",
        "missing_records": "SELECT 0::BIGINT AS missing_s1, count(*) FILTER (WHERE starts_with(cand_id, 'S3-')) AS missing_candidates FROM known",
        "labels": "SELECT s1_id, cand_id, label FROM lab",
        "positives": "SELECT s1_id, cand_id FROM lab WHERE label = 1",
        "negatives": "SELECT s1_id, cand_id FROM lab WHERE label = 0",
        "label_balance": "SELECT sum(label)::BIGINT AS positives, (count(*) - sum(label))::BIGINT AS negatives, round((count(*) - sum(label))::DOUBLE / greatest(sum(label), 1), 6) AS ratio, round(greatest(count(*) - sum(label), 1)::DOUBLE / greatest(sum(label), 1), 6) AS positive_weight FROM lab",
        "sampled_pairs": f"SELECT s1_id, cand_id, label FROM (SELECT *, sum(label) OVER (PARTITION BY s1_id) AS pos, row_number() OVER (PARTITION BY s1_id, label ORDER BY {_PLACE.format('cand_id')}, cand_id) AS n FROM lab) WHERE label = 1 OR n <= CASE WHEN pos > 0 THEN 5 * pos ELSE 2 END",
        "entity_split": f"SELECT s1_id, row_number() OVER (ORDER BY {_PLACE.format('s1_id')}, s1_id) <= greatest(1, floor((SELECT count(*) FROM ents) * 0.1)) AS is_val FROM ents",
        "entity_f05": f"SELECT s1_id, tp, pp, rp, {_rounded('precision recall f05')} FROM each",
        "evaluation_report": f"""SELECT round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f05), 6) AS macro_f05, round(sum(tp)::DOUBLE / sum(pp), 6) AS micro_precision,
  round(sum(tp)::DOUBLE / sum(rp), 6) AS micro_recall, round(1.25::DOUBLE * sum(tp) / (sum(pp) + 0.25::DOUBLE * sum(rp)), 6) AS micro_f05,
  round(count(*) FILTER (WHERE rp = 0 AND pp = 0)::DOUBLE / count(*) FILTER (WHERE rp = 0), 6) AS singleton_accuracy, count(*) AS entities, count(*) FILTER (WHERE rp = 0) AS singletons,
  count(*) FILTER (WHERE rp > 0) AS matched, sum(tp)::BIGINT AS tp, sum(pp)::BIGINT AS pp, sum(rp)::BIGINT AS rp FROM each""",
        "macro_f05": "SELECT round(avg(f05), 6) AS macro_f05 FROM each",
        "f05_distribution": "SELECT round(avg(f05), 6) AS mean, round(median(f05), 6) AS median, round(min(f05), 6) AS least, round(max(f05), 6) AS greatest FROM each",
        "tuning_metrics": f"SELECT {_rounded('precision recall f05 f1')} FROM (SELECT *, {_F1} FROM (SELECT {_MEANS} FROM cnt))",
        "threshold_curve": f"SELECT {_rounded('threshold precision recall f05 f1')} FROM curve",
        "best_threshold": f"SELECT {_rounded('threshold f05')} FROM (SELECT threshold, f05 FROM curve ORDER BY round(f05, 9) DESC, threshold LIMIT 1)",
        "linear_scores": f"SELECT s1_id, cand_id, round(1 / (1 + exp(-(-4.0::DOUBLE + 3.0::DOUBLE * {_jaccard('an', 'bn')} + 4.0::DOUBLE * {_both('an', 'bn', '1 - levenshtein(an, bn)::DOUBLE / greatest(length(an), length(bn))')}))), 6) AS proba FROM meas",
        "union_sources": "SELECT entity_id, country FROM doc WHERE source <> 'S1'",
        "matching_results": _MATCHED,
        "candidate_results": _LISTS.format("SELECT * FROM known WHERE starts_with(cand_id, 'S2-')", "candidate_entity_ids"),
        "match_rate": f"SELECT count(*) AS entities, count(*) FILTER (WHERE matched_entity_ids <> '') AS matched, count(*) FILTER (WHERE matched_entity_ids = '') AS singletons, round(100.0 * count(*) FILTER (WHERE matched_entity_ids <> '') / greatest(count(*), 1), 2) AS match_rate FROM ({_MATCHED})",
        "consistency_violations": "SELECT s1_id, cand_id FROM truth t ANTI JOIN (SELECT s1_id, cand_id FROM top WHERE field = 'address') k USING (s1_id, cand_id)",
        "coverage_missing": "SELECT s1_id FROM ents ANTI JOIN known USING (s1_id)",
        "profile_columns": _column_profile(),
        "profile_nulls": "WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)) " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(100.0 * (count(*) - count({c})) / greatest(count(*), 1), 2) AS null_pct FROM j" for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")),
        "profile_duplicates": "SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_duplicates, round(100.0 * (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem))) / greatest(count(*), 1), 2) AS duplicate_pct FROM lineitem",
        "profile_describe": _describe(),
        "profile_lengths": _LENGTHS,
        "length_histogram": _HISTOGRAM,
        "value_counts_country": "SELECT coalesce(nullif(country, ''), 'MISSING') AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM doc), 2) AS pct FROM doc GROUP BY 1 ORDER BY n DESC, value LIMIT 20",
        "label_counts": "SELECT coalesce(label::VARCHAR, 'MISSING') AS value, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM embeddings), 2) AS pct FROM embeddings GROUP BY 1 ORDER BY n DESC, value LIMIT 20",
        "id_uniqueness": "SELECT count(doc_id) AS total, count(DISTINCT doc_id) AS n_unique, count(doc_id) - count(DISTINCT doc_id) AS n_duplicate FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE quality = 0)",
        "dataset_summary": _summary(),
    }.items()
}
