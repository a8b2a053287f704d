"""SQL that states each query's result a second time, for DuckDB on the same tables.

Written to be plainly right, not fast: where the Spark plan avoids forming pairs,
the SQL here forms them.
"""

from __future__ import annotations

from linkweave.operators import model

NOW = "TIMESTAMP '2024-03-01 00:00:00'"
PAIR = "source_type, source_id, target_type, target_id"
MODEL_COLUMNS = ["name_match_score", "first_name_match", "last_name_match", "npi_match"]
FLAGS = {
    "first_name": "first_name_match",
    "middle_name": "middle_name_match",
    "last_name": "last_name_match",
    "country": "country_match",
    "npi": "npi_match",
    "organization_name": "organization_name_match",
}
SPACES = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# Latin letters without a decomposition, spelled in ASCII.
SPELLINGS = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ø": "o", "đ": "d", "ð": "d",
    "ł": "l", "ħ": "h", "ı": "i", "ŋ": "ng", "ĳ": "ij", "ŧ": "t",
}


def _ascii(c: str) -> str:
    e = f"lower(replace({c}, 'null', ''))"
    for letter, spelling in SPELLINGS.items():
        e = f"replace({e}, '{letter}', '{spelling}')"
    return f"regexp_replace(strip_accents({e}), '[^a-z -]', '', 'g')"


def _key(c: str) -> str:
    return f"nullif(substr({_ascii(c)}, 1, 1), '')"


def _prep(c: str) -> str:
    return f"lower(regexp_replace({c}, '^{SPACES}+|{SPACES}+$', '', 'g'))"


def _flag(a: str) -> str:
    return (
        f"CASE WHEN {_prep('s.' + a)} = {_prep('t.' + a)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    )


_NAME = "concat_ws(' ', nullif({0}, ''), nullif({1}, ''), nullif({2}, ''))".format(
    _ascii("first_name"), _ascii("middle_name"), _ascii("last_name")
)

VIEWS = {
    "record_version": """
        SELECT CASE WHEN doc_id % 2 = 0 THEN 'gpo' ELSE 'pm' END AS record_type,
               doc_id AS record_id,
               nullif(split_part(t, ' ', 1), '') AS first_name,
               nullif(split_part(t, ' ', 2), '') AS middle_name,
               CASE WHEN ver = 0 AND doc_id % 10 = 0 THEN 'null' ELSE nullif(split_part(t, ' ', 3), '') END AS last_name,
               lang AS country, source AS organization_name, h AS npi, n_chars AS publication_count,
               CASE WHEN doc_id % 50 = 0 THEN 0 WHEN doc_id % 50 = 2 THEN NULL
                    ELSE CAST(11 + doc_id % 7 AS INT) END AS collection_source_id,
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id + ver * 100000) AS tess_modified_at
        FROM (SELECT doc_id, replace(text, chr(10), ' ') AS t, md5(text) AS h, lang, source, n_chars FROM documents) w
        CROSS JOIN (SELECT 0 AS ver UNION ALL SELECT 1) v
        WHERE ver = 0 OR doc_id % 10 = 0""",
    "record": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY record_type, record_id ORDER BY tess_modified_at DESC) AS rn
          FROM record_version) WHERE rn = 1""",
    "feedback": """
        SELECT 'gpo' AS source_type, source_id, 'pm' AS target_type, target_id,
               CASE WHEN ver = 0 THEN NOT y ELSE y END AS is_match,
               TIMESTAMP '2024-02-01 00:00:00' + to_minutes(source_id + ver * 100000) AS tess_modified_at
        FROM (
          SELECT s.doc_id AS source_id, min(t.doc_id) AS target_id, true AS y
          FROM documents s JOIN documents t ON md5(s.text) = md5(t.text)
          WHERE s.doc_id % 2 = 0 AND t.doc_id % 2 = 1 GROUP BY s.doc_id
          UNION ALL
          SELECT s.doc_id, t.doc_id, false FROM documents s JOIN documents t ON t.doc_id = s.doc_id + 1
          WHERE s.doc_id % 2 = 0 AND md5(s.text) <> md5(t.text)) p
        CROSS JOIN (SELECT 0 AS ver UNION ALL SELECT 1) v
        WHERE ver = 1 OR source_id % 3 = 0""",
    "current_feedback": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY {PAIR} ORDER BY tess_modified_at DESC) AS rn
          FROM feedback) WHERE rn = 1""",
    "labelled_pairs": f"SELECT DISTINCT {PAIR} FROM feedback",
    "block_record": f"""
        SELECT DISTINCT record_type, record_id, block, 'run_1' AS run_id, {NOW} AS created_at FROM (
          SELECT record_type, record_id, {_key('first_name')} AS block FROM record
          UNION ALL
          SELECT record_type, record_id, {_key('middle_name')} FROM record WHERE record_type = 'gpo'
          UNION ALL
          SELECT record_type, record_id, {_key('last_name')} FROM record WHERE record_type = 'gpo')
        WHERE block IS NOT NULL""",
    "block_pairs": """
        SELECT DISTINCT s.record_id AS source_id, t.record_id AS target_id
        FROM block_record s JOIN block_record t ON s.block = t.block
        WHERE s.record_type = 'gpo' AND t.record_type = 'pm'""",
    "typed_names": f"""
        SELECT record_type, record_id, CASE WHEN record_type = 'pm' AND record_id % 3 = 1
            THEN substr(name, 1, 2) || substr(name, 4) ELSE name END AS name
        FROM (SELECT record_type, record_id, {_NAME} AS name FROM record)""",
    "name_terms": f"""
        SELECT DISTINCT record_type, record_id, term FROM (
          SELECT record_type, record_id, trim({_ascii('first_name')}) AS term FROM record
          UNION ALL SELECT record_type, record_id, trim({_ascii('middle_name')}) FROM record
          UNION ALL SELECT record_type, record_id, trim({_ascii('last_name')}) FROM record)
        WHERE term <> ''""",
    "term_weights": """
        SELECT term, CAST(round(power(ln((1.0 + (SELECT count(*) FROM record)) / (1.0 + count(*))) + 1.0, 2) * 1000000) AS BIGINT) AS weight
        FROM name_terms GROUP BY term""",
    "name_lengths": """
        SELECT record_type, record_id, sum(weight)::DOUBLE AS len
        FROM name_terms JOIN term_weights USING (term) GROUP BY ALL""",
    "name_cosines": """
        SELECT p.source_id, p.target_id,
               CASE WHEN d.dot IS NULL THEN 0.0::DOUBLE ELSE d.dot / sqrt(a.len * b.len) END AS score
        FROM block_pairs p
        LEFT JOIN (
          SELECT s.record_id AS source_id, t.record_id AS target_id, sum(weight)::DOUBLE AS dot
          FROM name_terms s JOIN name_terms t ON s.term = t.term JOIN term_weights w ON w.term = s.term
          WHERE s.record_type = 'gpo' AND t.record_type = 'pm' GROUP BY ALL
        ) d ON d.source_id = p.source_id AND d.target_id = p.target_id
        LEFT JOIN name_lengths a ON a.record_type = 'gpo' AND a.record_id = p.source_id
        LEFT JOIN name_lengths b ON b.record_type = 'pm' AND b.record_id = p.target_id""",
    "match_scores": f"""
        SELECT run_id, 'gpo' AS source_type, s.doc_id AS source_id, 'pm' AS target_type, t.doc_id AS target_id,
               CASE WHEN run_id = 'run_0' THEN 0.99::DOUBLE
                    WHEN (s.doc_id + t.doc_id) % 97 = 0 THEN NULL
                    WHEN s.doc_id % 8 = 2 THEN round(((s.doc_id * 31 + t.doc_id * 17) % 1000) / 1000.0::DOUBLE * 0.15::DOUBLE, 6)
                    ELSE ((s.doc_id * 31 + t.doc_id * 17) % 1000) / 1000.0::DOUBLE END AS score,
               'pre_1' AS pre_train_model_id, 'post_1' AS post_train_model_id,
               {NOW} - to_hours(CAST(CASE WHEN run_id = 'run_0' THEN t.doc_id ELSE s.doc_id END % 3 AS INT)) AS created_at
        FROM documents s
        JOIN documents t ON t.doc_id - s.doc_id BETWEEN 1 AND 13 AND t.doc_id % 2 = 1
        CROSS JOIN (SELECT 'run_0' AS run_id UNION ALL SELECT 'run_1') r
        WHERE s.doc_id % 2 = 0""",
    "current_scores": "SELECT * FROM match_scores WHERE run_id = 'run_1'",
    "top_scores": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT run_id, source_type, source_id, target_type, target_id, score,
                 row_number() OVER (PARTITION BY run_id, source_id ORDER BY score DESC NULLS LAST, target_id) AS rn
          FROM current_scores)
        WHERE (rn <= 5 AND score >= 0.2) OR rn = 1""",
    "pair_features": f"""
        SELECT {PAIR},
               CASE WHEN greatest(length(s.full_name), length(t.full_name)) = 0 THEN 0.0::DOUBLE
                    ELSE 1.0::DOUBLE - levenshtein(s.full_name, t.full_name)::DOUBLE / greatest(length(s.full_name), length(t.full_name)) END AS name_match_score,
               {', '.join(f'{_flag(a)} AS {f}' for a, f in FLAGS.items())},
               0.0::DOUBLE AS specialty_match, 0.0::DOUBLE AS other_ids_match,
               coalesce(f.n, 0) AS f_name_freq_src, coalesce(l.n, 0) AS l_name_freq_src
        FROM labelled_pairs p
        JOIN (SELECT *, {_NAME} AS full_name FROM record WHERE record_type = 'gpo') s ON s.record_id = p.source_id
        JOIN (SELECT *, {_NAME} AS full_name FROM record WHERE record_type = 'pm') t ON t.record_id = p.target_id
        LEFT JOIN (SELECT first_name, count(*) AS n FROM record WHERE record_type = 'gpo' GROUP BY 1) f ON f.first_name = s.first_name
        LEFT JOIN (SELECT last_name, count(*) AS n FROM record WHERE record_type = 'gpo' GROUP BY 1) l ON l.last_name = s.last_name""",
    "feature_rows": f"""
        SELECT * , {NOW} AS created_at FROM pair_features
        UNION ALL
        SELECT * REPLACE (0.0::DOUBLE AS name_match_score), TIMESTAMP '2024-02-28 00:00:00' FROM pair_features""",
    "assembly": f"""
        SELECT b.score AS ds_combined_score, a.source_id, s.collection_source_id AS collection_source_id_src,
               s.first_name AS first_name_src, s.middle_name AS middle_name_src, s.last_name AS last_name_src,
               s.country AS country_src, s.npi AS npi_src, s.organization_name AS organization_name_src,
               b.target_id,
               t.first_name AS first_name_tgt, t.middle_name AS middle_name_tgt, t.last_name AS last_name_tgt,
               t.country AS country_tgt, t.npi AS npi_tgt, t.organization_name AS organization_name_tgt,
               round(f.name_match_score, 6) AS fg_legacy_name_match_score,
               {', '.join(f'f.{c} AS fg_legacy_{c}' for c in [*FLAGS.values(), 'specialty_match', 'other_ids_match', 'f_name_freq_src', 'l_name_freq_src'])}
        FROM (SELECT DISTINCT record_id AS source_id FROM block_record WHERE record_type = 'gpo') a
        LEFT JOIN top_scores b ON b.source_id = a.source_id
        JOIN record s ON s.record_type = 'gpo' AND s.record_id = a.source_id
        LEFT JOIN record t ON t.record_type = 'pm' AND t.record_id = b.target_id
        LEFT JOIN pair_features f ON f.source_id = b.source_id AND f.target_id = b.target_id""",
    "decided": """
        SELECT source_id, target_id FROM current_scores WHERE (source_id + target_id) % 5 = 0""",
    "import_log": """
        SELECT event_type AS record_type, event_id AS record_id, user_id, ts AS tess_modified_at, value FROM events""",
    "stored_log": "SELECT * FROM import_log WHERE tess_modified_at < TIMESTAMP '2024-01-10 00:00:00'",
    "lookup_source": """
        SELECT n_nationkey AS LookupID, n_name AS LookupValue, CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE 1 END AS IsActive FROM nation""",
    "batch_collection_source": """
        SELECT s_suppkey AS BatchId, s_nationkey AS CollectionSourceId, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS IsActive FROM supplier""",
    "batch": """
        SELECT s_suppkey AS BatchId, s_suppkey % 7 AS ConfigurationId, CASE WHEN s_suppkey % 6 = 0 THEN 2 ELSE 1 END AS Status FROM supplier""",
    "matching_result": """
        SELECT s_suppkey + 1000 AS MatchingResultId, s_suppkey AS BatchId,
               CASE WHEN s_suppkey % 9 = 0 THEN 'other_rule' ELSE 'people_generic_rule' END AS RuleName FROM supplier""",
    "configuration": """
        SELECT p_partkey AS ConfigurationId, 'cfg ' || p_name AS ConfigurationName,
               CASE p_partkey % 3 WHEN 0 THEN '{"b": [1, 2], "a": "x"}' WHEN 1 THEN '{"a": "x", "b": [1, 2]}'
                    ELSE '{"a": "y"}' END AS ColumnSchema FROM part""",
    "last_batch": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY CollectionSourceId ORDER BY BatchId DESC) AS rn
          FROM batch_collection_source) WHERE rn = 1""",
    "config_rows": """
        SELECT ls.LookupID AS CollectionSourceId, ls.LookupValue AS collectionSourceName,
               x.BatchId, x.ConfigurationId, x.MatchingResultId, x.ConfigurationName, x.ColumnSchema
        FROM lookup_source ls LEFT JOIN (
          SELECT bcs.CollectionSourceId, b.BatchId, b.ConfigurationId, mr.MatchingResultId, c.ConfigurationName, c.ColumnSchema
          FROM last_batch bcs JOIN batch b ON b.BatchId = bcs.BatchId
          JOIN matching_result mr ON mr.BatchId = b.BatchId
          JOIN configuration c ON c.ConfigurationId = b.ConfigurationId
          WHERE bcs.IsActive = 1 AND b.Status = 1 AND mr.RuleName = 'people_generic_rule') x
        ON x.CollectionSourceId = ls.LookupID WHERE ls.IsActive = 1""",
    "decisions": """
        SELECT CollectionSourceId, collectionSourceName,
               CASE WHEN same THEN 1 ELSE 0 END AS append_mode,
               CASE WHEN same THEN BatchId END AS BatchId,
               CASE WHEN same THEN ConfigurationId END AS ConfigurationId,
               CASE WHEN same THEN MatchingResultId END AS MatchingResultId
        FROM (SELECT *, BatchId IS NOT NULL AND ColumnSchema IN ('{"b": [1, 2], "a": "x"}', '{"a": "x", "b": [1, 2]}') AS same
              FROM config_rows)""",
    "assigned": """
        SELECT CollectionSourceId, collectionSourceName, append_mode, BatchId, ConfigurationId, MatchingResultId
        FROM decisions WHERE append_mode = 1
        UNION ALL
        SELECT CollectionSourceId, collectionSourceName, append_mode,
               (SELECT max(BatchId) FROM batch) + rn, (SELECT max(ConfigurationId) FROM configuration) + rn,
               (SELECT max(MatchingResultId) FROM matching_result) + rn
        FROM (SELECT *, row_number() OVER (ORDER BY CollectionSourceId) AS rn FROM decisions WHERE append_mode = 0)""",
    "pre_train_model": """
        SELECT 'pre_' || n_nationkey AS pre_train_model_id, 'is_match' AS dependent_variable,
               'fg_legacy.name_match_score|fg_legacy.' || lower(n_name) AS input_features, md5(n_name) AS model_code_hash FROM nation""",
    "run_model_inference": """
        SELECT 'run_' || (s_suppkey % 4) AS run_id, 'pre_' || s_nationkey AS pre_train_model_id,
               'post_' || s_suppkey AS post_train_model_id, s_suppkey % 3 = 0 AS is_primary FROM supplier""",
    "words": r"""
        SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents""",
    "counts": "SELECT doc_id, term, count(*) AS n FROM words GROUP BY ALL",
    "term_df": "SELECT term, count(*) AS df FROM counts GROUP BY term",
    "raw_tfidf": """
        SELECT doc_id, term, n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
        FROM counts JOIN term_df USING (term)""",
    "tfidf": """
        SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw_tfidf""",
    "training": f"""
        SELECT {PAIR}, fb.is_match, {', '.join(f'f.{c} AS fg_legacy_{c}' for c in MODEL_COLUMNS)}
        FROM current_feedback fb JOIN pair_features f USING ({PAIR}) WHERE fb.is_match IS NOT NULL""",
    "sampled": f"""
        SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY is_match ORDER BY
                   md5(concat_ws('|', '42', source_type, source_id, target_type, target_id))) AS rn FROM training)
        WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM training GROUP BY is_match))""",
    "backfill": f"""
        SELECT DISTINCT {PAIR} FROM feedback f
        WHERE NOT EXISTS (SELECT 1 FROM match_scores m WHERE m.source_id = f.source_id AND m.target_id = f.target_id)""",
}


def _with(body: str) -> str:
    """The query with every view it needs, directly or through another view, as a CTE."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name, text in VIEWS.items():
            if name not in needed and _mentions(sql, name):
                needed.add(name)
                visit(text)

    visit(body)
    # A view may name the views above it only, so the order of the list is right.
    parts = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _mentions(sql: str, name: str) -> bool:
    words = sql.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(
        word == name and before.upper() in ("FROM", "JOIN")
        for before, word in zip(words, words[1:])
    )


_A = "ds_combined_score, source_id, target_id, collection_source_id_src"
_ALLOWED = "coalesce(collection_source_id_src NOT IN (17, 42, 44, 66, 108, 120, 122), true)"
_LOW = "(ds_combined_score < 0.2 OR ds_combined_score IS NULL)"

_ODDS = f"({model.FIXED_INTERCEPT} + {model.FIXED_SCORE_WEIGHT} * fg_legacy_name_match_score" + "".join(
    f" + {model.FIXED_WEIGHTS[a]} * fg_legacy_{a}_match" for a in ("first_name", "last_name", "npi")
) + ")"

BODIES = {
    "watermark_max": """
        SELECT record_type, max(tess_modified_at) AS last_modified_at, max(record_id) AS last_record_id
        FROM stored_log GROUP BY record_type""",
    "import_range_ts": """
        SELECT l.record_type, l.record_id, l.tess_modified_at
        FROM import_log l JOIN (SELECT record_type, max(tess_modified_at) AS mark FROM stored_log GROUP BY 1) m ON m.record_type = l.record_type
        WHERE l.tess_modified_at > mark AND l.tess_modified_at <= mark + INTERVAL 14 DAY""",
    "import_range_id": """
        SELECT l.record_type, l.record_id
        FROM import_log l JOIN (SELECT record_type, max(record_id) AS mark FROM stored_log GROUP BY 1) m ON m.record_type = l.record_type
        WHERE l.record_id > mark AND l.record_id <= mark + 500000""",
    "feedback_range": """
        SELECT record_type, strftime(s, '%Y-%m-%d %H:%M:%S:') || strftime(s, '%g') AS range_start,
               strftime(s + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S:') || strftime(s, '%g') AS range_end
        FROM (SELECT record_type, coalesce(max(tess_modified_at) FILTER (value > 0 AND record_type <> 'view'), TIMESTAMP '2021-01-01 00:00:00') AS s
              FROM import_log GROUP BY record_type)""",
    "ts_format_ms": """
        SELECT record_id, strftime(tess_modified_at, '%Y-%m-%d %H:%M:%S:') || strftime(tess_modified_at, '%g') AS modified_text FROM import_log""",
    "pm_modified_fill": f"""
        SELECT record_type, record_id, publication_count,
               CASE WHEN record_type = 'pm' THEN {NOW} ELSE tess_modified_at END AS tess_modified_at FROM record_version""",
    "upsert_latest_wins": "SELECT record_type, record_id, last_name, tess_modified_at FROM record",
    "upsert_ties": """
        SELECT record_type, record_id, CASE WHEN record_id % 3 = 0 THEN 'changed' ELSE last_name END AS last_name,
               tess_modified_at FROM record""",
    "mixed_import_columns": """
        SELECT record_type, record_id, first_name, CASE WHEN record_type = 'pm' THEN npi END AS npi,
               CASE WHEN record_type = 'gpo' THEN country END AS country, record_type || '-import' AS import_process_id
        FROM record""",
    "export_after_rescoring": f"SELECT {_A} FROM assembly",
    "detail_rows_appended": f"""
        SELECT source_id AS sourceid, target_id AS targetid,
               CASE WHEN swapped THEN source ELSE score END AS fieldvalue1, CASE WHEN swapped THEN score ELSE source END AS fieldvalue2,
               'EMUser' AS CreatedBy, {NOW} AS CreatedDate, MatchingResultId
        FROM (SELECT a.source_id, a.target_id, CAST(a.ds_combined_score AS VARCHAR) AS score,
                     CAST(a.collection_source_id_src AS VARCHAR) AS source, x.MatchingResultId,
                     x.append_mode = 1 AND x.BatchId % 2 = 1 AS swapped
              FROM assembly a JOIN assigned x ON x.CollectionSourceId = a.collection_source_id_src
              WHERE a.ds_combined_score >= 0.2)""",
    "rejected_matches": f"""
        SELECT {_A} FROM assembly a WHERE ds_combined_score >= 0.2 AND NOT EXISTS (
          SELECT 1 FROM config_rows c WHERE c.CollectionSourceId = a.collection_source_id_src)""",
    "classified_targets": f"""
        SELECT 'gpo' AS source_type, source_id, 'pm' AS target_type, target_id, round(1 / (1 + exp(-z)), 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY z DESC, target_id) AS rn FROM (
            SELECT p.source_id, p.target_id, {model.FIXED_INTERCEPT}::DOUBLE
                   + {" + ".join(f"{w}::DOUBLE * {_flag(a)}" for a, w in model.FIXED_WEIGHTS.items())} AS z
            FROM block_pairs p
            JOIN record s ON s.record_type = 'gpo' AND s.record_id = p.source_id
            JOIN record t ON t.record_type = 'pm' AND t.record_id = p.target_id))
        WHERE (rn <= 5 AND 1 / (1 + exp(-z)) >= 0.2) OR rn = 1""",
    "near_names": """
        SELECT DISTINCT s.name AS source_name, t.name AS target_name, levenshtein(s.name, t.name)::INTEGER AS edits
        FROM block_pairs p
        JOIN typed_names s ON s.record_type = 'gpo' AND s.record_id = p.source_id
        JOIN typed_names t ON t.record_type = 'pm' AND t.record_id = p.target_id
        WHERE greatest(length(s.name), length(t.name)) > 0
          AND levenshtein(s.name, t.name) * 100 <= 20 * greatest(length(s.name), length(t.name))""",
    "block_key_scripts": f"""
        SELECT record_type, record_id, script, {_key('first_name')} AS block FROM record
        CROSS JOIN (VALUES ('greek'), ('cyrillic'), ('hebrew'), ('arabic'), ('katakana'), ('hangul')) v(script)""",
    "ties_within_import": """
        SELECT record_type, record_id, CASE WHEN record_id % 3 = 0 THEN 'second' ELSE last_name END AS last_name FROM record""",
    "compacted_records": """
        SELECT record_type, record_id, last_name, tess_modified_at FROM (
          SELECT *, row_number() OVER (PARTITION BY record_type, record_id ORDER BY tess_modified_at DESC) AS rn FROM (
            SELECT record_type, record_id, last_name, tess_modified_at FROM record_version WHERE record_id % 5 <> 2
            UNION ALL
            SELECT record_type, record_id, 'changed', tess_modified_at + INTERVAL 1 DAY FROM record_version WHERE record_id % 4 <> 1))
        WHERE rn = 1""",
    "rerun_empty": """
        SELECT record_type, record_id, last_name, 'run_1' AS run_id, 'a' AS part FROM record WHERE record_id % 2 = 0""",
    "forest_score_keys": f"""
        SELECT {PAIR}, 'run_1' AS run_id, true AS is_probability, true AS has_model FROM pair_features f WHERE EXISTS (
          SELECT 1 FROM block_record s JOIN block_record t ON s.block = t.block
          WHERE s.record_type = f.source_type AND s.record_id = f.source_id AND t.record_type = f.target_type
            AND t.record_id = f.target_id AND s.block BETWEEN 'a' AND 'z')""",
    "train_accuracy_bounds": "SELECT count(*) AS n, true AS beats_chance FROM sampled",
    "add_metadata": f"""
        SELECT record_type, record_id, tess_modified_at, 'run_1' AS run_id, 'process_1' AS process_id, {NOW} AS imported_at FROM record_version""",
    "cast_map": """
        SELECT record_type, record_id, collection_source_id, TRY_CAST(last_name AS INT) AS clinical_trial_count,
               CAST(publication_count AS INT) AS publication_count, tess_modified_at FROM record_version""",
    "label_to_bool": """
        SELECT source_id, target_id, CASE WHEN source_id % 7 <> 0 THEN is_match END AS is_match, tess_modified_at FROM feedback""",
    "null_sentinel": """
        SELECT record_type, record_id, tess_modified_at,
               coalesce(middle_name, 'null') AS middle_name_filled, coalesce(last_name, 'null') AS last_name_filled,
               nullif(middle_name, 'null') AS middle_name, nullif(last_name, 'null') AS last_name FROM record_version""",
    "suffix_columns": """
        SELECT record_type AS record_type_src, record_id AS record_id_src, first_name AS first_name_src, country AS country_src FROM record""",
    "pair_key_roundtrip": f"""
        SELECT 'gpo_' || source_id AS pk_src, 'pm_' || target_id AS pk_tgt, {PAIR} FROM labelled_pairs""",
    "drop_incomplete": """
        SELECT source_id, target_id, score, 1.0::DOUBLE AS weight FROM current_scores WHERE score IS NOT NULL AND target_id % 11 <> 0""",
    "block_filter": "SELECT record_type, record_id, block FROM block_record WHERE block BETWEEN 'a' AND 'z'",
    "drop_missing_source": f"SELECT {_A} FROM assembly WHERE collection_source_id_src IS DISTINCT FROM 0",
    "missing_source_ids": "SELECT DISTINCT source_id FROM assembly WHERE collection_source_id_src = 0",
    "match_split": f"SELECT {_A} FROM assembly WHERE ds_combined_score >= 0.2",
    "no_match_split": f"SELECT {_A} FROM assembly WHERE {_LOW}",
    "no_match_blocklist": f"SELECT {_A} FROM assembly WHERE {_LOW} AND {_ALLOWED}",
    "feature_projection": f"""
        SELECT {PAIR}, created_at, round(name_match_score, 6) AS fg_legacy_name_match_score,
               {', '.join(f'{c} AS fg_legacy_{c}' for c in [*FLAGS.values(), 'specialty_match', 'other_ids_match', 'f_name_freq_src', 'l_name_freq_src'])}
        FROM feature_rows""",
    "no_match_export": f"""
        SELECT first_name_tgt AS TargetFirstName, middle_name_tgt AS TargetMiddleName, last_name_tgt AS TargetLastName,
               npi_tgt AS TargetNpi, organization_name_tgt AS TargetOrganizationName, CAST(NULL AS VARCHAR) AS TargetOtherIds,
               fg_legacy_country_match AS TargetCountryMatch, fg_legacy_npi_match AS TargetNpiMatch,
               fg_legacy_organization_name_match AS TargetOrganizationNameMatch,
               source_id AS SourceID, target_id AS TargetID, CAST(NULL AS VARCHAR) AS TargetSpeciality,
               fg_legacy_specialty_match AS TargetSpecialityMatch, fg_legacy_name_match_score AS DSNameMatchScore,
               fg_legacy_f_name_freq_src AS FirstNameFrequency, fg_legacy_l_name_freq_src AS LastNameFrequency,
               fg_legacy_first_name_match AS FirstNameMatch, fg_legacy_middle_name_match AS MiddleNameMatch,
               fg_legacy_last_name_match AS LastNameMatch, fg_legacy_other_ids_match AS OtherIdsMatch
        FROM assembly WHERE {_LOW} AND {_ALLOWED} AND collection_source_id_src IS DISTINCT FROM 0""",
    "full_names": """
        SELECT concat_ws(' ', first_name_tgt, middle_name_tgt, last_name_tgt) AS full_name_tgt,
               concat_ws(' ', first_name_src, middle_name_src, last_name_src) AS full_name_src,
               source_id, target_id, ds_combined_score FROM assembly WHERE ds_combined_score >= 0.2""",
    "premaster_flag": """
        SELECT record_type, record_id, record_type <> 'pm' AS to_master, record_type = 'pm' AS from_gpo FROM record""",
    "dedup_records": """
        SELECT record_type, record_id, last_name, tess_modified_at FROM (
          SELECT *, row_number() OVER (PARTITION BY record_type, record_id ORDER BY last_name NULLS LAST, tess_modified_at) AS rn
          FROM record_version) WHERE rn = 1""",
    "dedup_pairs": f"""
        SELECT {PAIR}, run_id, score, created_at FROM (
          SELECT *, row_number() OVER (PARTITION BY {PAIR} ORDER BY created_at DESC, run_id, score NULLS LAST) AS rn
          FROM match_scores) WHERE rn = 1""",
    "all_sources": "SELECT DISTINCT record_id AS source_id FROM block_record WHERE record_type = 'gpo' AND run_id = 'run_1'",
    "latest_records": "SELECT * FROM record",
    "latest_feedback": "SELECT * FROM current_feedback",
    "latest_features": f"SELECT {PAIR}, {NOW} AS created_at, round(name_match_score, 6) AS name_match_score FROM pair_features",
    "top_k_with_fallback": "SELECT * FROM top_scores",
    "auto_approve_best": """
        SELECT source_id, target_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, target_id) AS rn
          FROM current_scores WHERE score >= 0.9) WHERE rn = 1""",
    "latest_batch": "SELECT * FROM last_batch",
    "block_key": f"""
        SELECT record_type, record_id, tess_modified_at, {_key('first_name')} AS first_name_block,
               {_key('middle_name')} AS middle_name_block, {_key('last_name')} AS last_name_block FROM record_version""",
    "blocks": "SELECT run_id, record_type, record_id, block, created_at FROM block_record",
    "block_stats": """
        SELECT (SELECT count(*) FROM record) AS n_records, (SELECT count(*) FROM block_record) AS n_block_rows""",
    "candidate_pairs": "SELECT source_id, count(*) AS n_candidates FROM block_pairs GROUP BY source_id",
    "best_targets": """
        SELECT 'gpo' AS source_type, source_id, 'pm' AS target_type, target_id, round(score, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, target_id) AS rn FROM name_cosines)
        WHERE (rn <= 5 AND score >= 0.2) OR rn = 1""",
    "pairs_in_blocks": f"""
        SELECT {', '.join('p.' + c.strip() for c in PAIR.split(','))}, s.block, 'run_1' AS run_id FROM labelled_pairs p
        JOIN block_record s ON s.record_type = p.source_type AND s.record_id = p.source_id
        JOIN block_record t ON t.record_type = p.target_type AND t.record_id = p.target_id AND t.block = s.block""",
    "pair_attributes": f"""
        SELECT {PAIR}, s.first_name AS first_name_src, s.npi AS npi_src, s.country AS country_src,
               t.first_name AS first_name_tgt, t.npi AS npi_tgt, t.country AS country_tgt
        FROM labelled_pairs p JOIN record s ON s.record_type = p.source_type AND s.record_id = p.source_id
        JOIN record t ON t.record_type = p.target_type AND t.record_id = p.target_id""",
    "training_set": "SELECT * REPLACE (round(fg_legacy_name_match_score, 6) AS fg_legacy_name_match_score) FROM training",
    "scoring_set": f"""
        SELECT {PAIR}, round(name_match_score, 6) AS fg_legacy_name_match_score,
               {', '.join(f'{c} AS fg_legacy_{c}' for c in MODEL_COLUMNS[1:])}
        FROM pair_features f WHERE EXISTS (
          SELECT 1 FROM block_record s JOIN block_record t ON s.block = t.block
          WHERE s.record_type = f.source_type AND s.record_id = f.source_id AND t.record_type = f.target_type
            AND t.record_id = f.target_id AND s.block BETWEEN 'a' AND 'z')""",
    "export_assembly": "SELECT * FROM assembly",
    "undecided_pairs": """
        SELECT source_id, target_id, score FROM current_scores c
        WHERE NOT EXISTS (SELECT 1 FROM decided d WHERE d.source_id = c.source_id AND d.target_id = c.target_id)""",
    "batch_config": "SELECT * FROM config_rows",
    "primary_model": """
        SELECT r.run_id, r.pre_train_model_id, r.post_train_model_id, m.dependent_variable, m.input_features, m.model_code_hash
        FROM run_model_inference r JOIN pre_train_model m USING (pre_train_model_id) WHERE r.is_primary""",
    "run_model": "SELECT * FROM run_model_inference WHERE run_id = 'run_1' AND pre_train_model_id = 'pre_20'",
    "backfill_pairs": "SELECT * FROM backfill",
    "backfill_src": """
        SELECT record_type, record_id, npi FROM record WHERE record_type = 'gpo' AND record_id IN (SELECT source_id FROM backfill)""",
    "backfill_tgt": """
        SELECT record_type, record_id, npi FROM record WHERE record_type = 'pm' AND record_id IN (SELECT target_id FROM backfill)""",
    "target_count": "SELECT source_id, count(*) AS target_count FROM assembly WHERE ds_combined_score >= 0.2 GROUP BY source_id",
    "class_counts": "SELECT is_match, count(*) AS n FROM training GROUP BY is_match",
    "name_frequency": """
        SELECT record_type, record_id,
               CASE WHEN first_name IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY first_name) END AS f_name_freq,
               CASE WHEN last_name IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY last_name) END AS l_name_freq
        FROM record WHERE record_type = 'gpo'""",
    "registry_append": """
        SELECT * REPLACE (CASE WHEN pre_train_model_id IN (SELECT pre_train_model_id FROM run_model_inference WHERE is_primary)
                               THEN model_code_hash ELSE model_code_hash || '-new' END AS model_code_hash)
        FROM pre_train_model""",
    "fixed_accuracy": f"""
        SELECT count(*) AS n, round(avg(CASE WHEN ({_ODDS} > 0) = is_match THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM sampled""",
    "fixed_scores": f"""
        SELECT {PAIR}, round(1.0 / (1.0 + exp(-{_ODDS})), 6) AS score, 'run_1' AS run_id
        FROM (SELECT {PAIR}, {', '.join(f'{c} AS fg_legacy_{c}' for c in MODEL_COLUMNS)} FROM pair_features) f WHERE EXISTS (
          SELECT 1 FROM block_record s JOIN block_record t ON s.block = t.block
          WHERE s.record_type = f.source_type AND s.record_id = f.source_id AND t.record_type = f.target_type
            AND t.record_id = f.target_id AND s.block BETWEEN 'a' AND 'z')""",
    "import_stage_rows": """
        SELECT record_type, record_id, first_name, nullif(last_name, 'null') AS last_name,
               CASE record_type WHEN 'pm' THEN TIMESTAMP '2030-01-01 00:00:00' ELSE tess_modified_at END AS tess_modified_at
        FROM record_version WHERE record_type = 'gpo' OR record_id > 1""",
    "feedback_stage_rows": f"SELECT {PAIR}, is_match, tess_modified_at, 'gpo' AS input_type FROM feedback",
    "stage_counts": """
        SELECT 'import-p1-' || record_type AS stage, 'records' AS name, count(*) AS n FROM record GROUP BY record_type
        UNION ALL SELECT 'import-p1-' || record_type, 'blocks', count(*) FROM block_record GROUP BY record_type
        UNION ALL SELECT 'feedback-p1-gpo', 'feedback', count(*) FROM feedback""",
    "split_counts": """
        SELECT collection_source_id_src, count(*) AS n_rows, count(DISTINCT source_id) AS n_sources FROM assembly
        WHERE ds_combined_score >= 0.2 AND collection_source_id_src IS DISTINCT FROM 0 GROUP BY 1""",
    "prep_text": f"""
        SELECT doc_id, md5({_prep("concat(' ', chr(9), chr(160), text, chr(10), '  ')")}) AS text_md5,
               CAST(length({_prep("concat(' ', chr(9), chr(160), text, chr(10), '  ')")}) AS INT) AS n_chars_prepared FROM documents""",
    "field_values": f"""
        SELECT a.source_id AS sourceid, a.target_id AS targetid, CAST(a.ds_combined_score AS VARCHAR) AS fieldvalue1,
               CAST(a.collection_source_id_src AS VARCHAR) AS fieldvalue2, substr(d.text, 1, 1000) AS fieldvalue3,
               'EMUser' AS CreatedBy, {NOW} AS CreatedDate, x.MatchingResultId
        FROM assembly a JOIN documents d ON d.doc_id = a.target_id
        JOIN assigned x ON x.CollectionSourceId = a.collection_source_id_src WHERE a.ds_combined_score >= 0.2""",
    "list_codec": """
        SELECT pre_train_model_id, CAST(len(string_split(input_features, '|')) AS INT) AS n_features,
               string_split(input_features, '|')[2] AS second_feature, input_features AS joined FROM pre_train_model""",
    "term_counts": "SELECT doc_id, term, n FROM counts JOIN term_df USING (term) WHERE df >= 2",
    "char_counts": r"""
        SELECT doc_id, term, n FROM (
          SELECT doc_id, term, count(*) AS n, count(*) OVER (PARTITION BY term) AS df FROM (
            SELECT doc_id, unnest(string_split(regexp_replace(lower(text), '\s\s+', ' ', 'g'), '')) AS term FROM documents)
          WHERE term <> '' GROUP BY doc_id, term)
        WHERE df >= 0.01 * (SELECT count(*) FROM documents)""",
    "tfidf_terms": "SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf",
    "pair_cosine": f"""
        SELECT {PAIR}, round(coalesce(c, 0.0), 6) AS cosine FROM labelled_pairs p
        LEFT JOIN (SELECT q.source_id AS sid, q.target_id AS tid, sum(a.weight * b.weight) AS c
                   FROM labelled_pairs q JOIN tfidf a ON a.doc_id = q.source_id
                   JOIN tfidf b ON b.doc_id = q.target_id AND b.term = a.term GROUP BY ALL) x
        ON x.sid = p.source_id AND x.tid = p.target_id""",
    "match_flags": f"SELECT {PAIR}, {', '.join(FLAGS.values())}, specialty_match, other_ids_match FROM pair_features",
    "name_match_score": f"SELECT {PAIR}, round(name_match_score, 6) AS name_match_score FROM pair_features",
    "undersample": f"SELECT {PAIR}, is_match FROM sampled",
    "undersample_counts": "SELECT is_match, count(*) AS n FROM sampled GROUP BY is_match",
    "batch_decision": "SELECT * FROM decisions",
    "assign_ids": "SELECT * FROM assigned",
    "batch_headers": f"""
        SELECT BatchId, ConfigurationId, 'EMUser' AS CreatedBy, {NOW} AS CreatedDate,
               'EM - ' || collectionSourceName AS Description, 1 AS Status, true AS IsPremastertoMaster,
               'CollectionSourceId ' || CollectionSourceId || ' - 2024-03-01' AS ConfigurationName,
               300 AS SourceProjectId, 251 AS TargetProjectId, '{{"a":"x","b":[1,2]}}' AS ColumnSchema,
               CollectionSourceId, 1 AS IsActive, MatchingResultId, 'people_generic_rule' AS RuleName,
               1 AS IsSuccessFul, 'XXXXXXXX-XXXXXXX' AS SourceIndexName, 'finalmaster' AS TargetIndexName
        FROM assigned WHERE append_mode = 0""",
    "auto_approve": """
        SELECT source_id AS SourceID, target_id AS TargetID, 2 AS CurrentStageID, 1 AS PreviousStageID, 1 AS UndoStageID,
               source_id % 3 AS BatchID, 'EM - Auto QA Approved' AS Comments, 'EMUser' AS CreatedBy, 'ApprovedQAPending' AS ActionType
        FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, target_id) AS rn
              FROM current_scores WHERE score >= 0.9) b
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM decided d WHERE d.source_id = b.source_id AND d.target_id = b.target_id)""",
}

ORACLE = {name: _with(body) for name, body in BODIES.items()}
