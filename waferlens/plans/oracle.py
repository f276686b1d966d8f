"""The SQL twin of each query, for DuckDB over the same tables.

Written from the meaning of the operators, not from the Spark plans. Doubles
that depend on summation order are rounded alike on both sides.
"""

from __future__ import annotations

from waferlens.config import feature_names, sensor_names
from waferlens.functions.columns import BLANK_CHARACTERS
from waferlens.plans.checks import PIPELINE_CHECKS
from waferlens.operators.search import DIMENSIONS
from waferlens.operators.train import DEPTH, TREES
from waferlens.plans.queries import BUILT_AT, COLLECTION, CONFIG, ENCODER, HOOK_WIDTH, LATE_EVERY, NEIGHBOURS, QUESTIONS

CHANNELS = 64
FEATURES = feature_names(CONFIG.top_sensors)
LIMIT_PCT = CONFIG.max_null_fraction * 100


def strip(expression: str) -> str:
    return f"trim({expression}, '{BLANK_CHARACTERS}')"


def pct(part: str, whole: str) -> str:
    return f"round(100.0 * ({part}) / ({whole}), 2)"


def ratio(part: str, whole: str) -> str:
    return f"(case when ({whole}) = 0 then 0.0 else ({part})::double / ({whole}) end)"


# --- named steps; each query lists the ones it stands on -------------------------------------

STEPS = {
    "raw": f"""
        select vec_id as wafer_id, c::int as sensor_id,
               case when (vec_id * 7 + c) % 11 = 0 then {CONFIG.sentinel}::double
                    else embedding[c]::double end as reading_value
        from embeddings, unnest(range(1, {CHANNELS + 1})) as channel(c)""",
    "matrix": f"""
        select vec_id as wafer_id, list_transform(
                   range(1, {CHANNELS + 1}),
                   lambda c: case when (vec_id * 7 + c) % 11 = 0 then {CONFIG.sentinel}::double
                                  else embedding[c]::double end) as cells
        from embeddings""",
    "picks": """
        select list(sensor_id order by sensor_rank) as ids,
               list(sensor_median order by sensor_rank) as fills
        from chosen join medians using (sensor_id)""",
    "staged": f"""
        select wafer_id, sensor_id, nullif(reading_value, {CONFIG.sentinel}::double) as reading_value,
               coalesce(reading_value = {CONFIG.sentinel}, false) as is_imputed_source_missing
        from raw""",
    "profile": f"""
        select sensor_id, count(*) as total_readings, count(reading_value) as non_null_readings,
               count(*) filter (where reading_value is null) as null_readings,
               {pct("count(*) filter (where reading_value is null)", "count(*)")} as null_pct,
               stddev_samp(reading_value) as reading_stddev, avg(reading_value) as reading_mean
        from staged group by sensor_id""",
    "quality": f"""
        select *, (row_number() over (order by null_pct > {LIMIT_PCT},
                                      reading_stddev desc nulls last, sensor_id))::int as sensor_rank
        from profile""",
    "chosen": f"""
        select sensor_id, sensor_rank from quality where sensor_rank <= {CONFIG.top_sensors}""",
    "kept": "select staged.* from staged semi join chosen using (sensor_id)",
    # The two middle readings, added and halved: equal to the last bit on both sides.
    "medians": """
        select sensor_id, (v[(len(v) + 1) // 2] + v[(len(v) + 2) // 2]) / 2 as sensor_median
        from (select sensor_id,
                     list_sort(list(reading_value) filter (where reading_value is not null)) as v
              from staged group by sensor_id)""",
    "imputed": """
        select wafer_id, sensor_id, sensor_rank, ifnull(reading_value, sensor_median) as reading_value,
               reading_value is null as was_imputed
        from kept join chosen using (sensor_id) join medians using (sensor_id)""",
    "features": """
        select wafer_id, max(was_imputed::int) as any_imputed_flag,
               count(*) filter (where was_imputed) as imputed_sensor_count, """
    + ", ".join(
        f"max(reading_value) filter (where sensor_rank = {rank}) as {name}"
        for rank, name in enumerate(FEATURES, start=1)
    )
    + " from imputed group by wafer_id",
    "log": """
        select event_id as wafer_id,
               case event_type when 'error' then -1 when 'signup' then 0 else 1 end as pass_fail_raw,
               case when event_id % 97 = 0 then 'bad'
                    else strftime(ts, '%-d/%-m/%Y %H:%M:%S') end as timestamp_str
        from events""",
    "tested": """
        select wafer_id, pass_fail_raw,
               case pass_fail_raw when 1 then 'pass' when -1 then 'fail' else 'unknown' end as yield_status,
               case pass_fail_raw when 1 then 0 when -1 then 1 end as is_fail,
               try_strptime(timestamp_str, '%d/%m/%Y %H:%M:%S') as tested_at
        from log""",
    "keyed": f"""
        select *, wafer_id % 89 <> 0 as readable, wafer_id % {LATE_EVERY} = 0 as late from log""",
    "timed": f"""
        select tested.*, wafer_id % {LATE_EVERY} = 0 as late
        from tested where tested_at is not null and wafer_id % 89 <> 0""",
    # How far the stream had got after its first delivery, and after the last one.
    "marks": """
        select max(tested_at) filter (where not late) - interval 2 days as middle,
               max(tested_at) - interval 2 days as final from timed""",
    "in_time": """
        select timed.* from timed, marks
        where not late or tested_at::date + interval 1 day > middle""",
    "closed": f"""
        select tested_at::date as test_date, count(*) as wafer_count,
               sum(is_fail)::bigint as fail_count, (count(*) - sum(is_fail))::bigint as pass_count,
               {pct("sum(is_fail)", "count(*)")} as fail_rate_pct,
               {pct("count(*) - sum(is_fail)", "count(*)")} as yield_rate_pct
        from in_time group by all""",
    "daily": f"""
        select tested_at::date as test_date, count(*) as wafer_count,
               sum(is_fail)::bigint as fail_count, (count(*) - sum(is_fail))::bigint as pass_count,
               {pct("sum(is_fail)", "count(*)")} as fail_rate_pct,
               {pct("count(*) - sum(is_fail)", "count(*)")} as yield_rate_pct
        from tested where tested_at is not null group by all""",
    "overall": f"""
        select count(*) as total_wafers, sum(is_fail)::bigint as total_fails,
               (count(*) - sum(is_fail))::bigint as total_passes,
               {pct("sum(is_fail)", "count(*)")} as overall_fail_rate_pct,
               {pct("count(*) - sum(is_fail)", "count(*)")} as overall_yield_rate_pct,
               min(tested_at) as first_test_at, max(tested_at) as last_test_at
        from tested""",
    "mart": f"""
        select wafer_id, yield_status, is_fail, tested_at, tested_at::date as test_date,
               any_imputed_flag, imputed_sensor_count, {", ".join(FEATURES)}
        from features join tested using (wafer_id)""",
    "scored": """
        select quality as truth, toxic as prediction, n_chars as score
        from labels join documents using (doc_id)""",
    "per_class": f"""
        select c, n,
               {ratio("hits", "predicted")} as p, {ratio("hits", "n")} as r,
               {ratio("2 * p * r", "p + r")} as f, hits
        from (select c,
                     count(*) filter (where truth = c and prediction = c) as hits,
                     count(*) filter (where prediction = c) as predicted,
                     count(*) filter (where truth = c) as n
              from scored, (values (0), (1)) as classes(c) group by c)""",
    "auc": """
        select sum(pos * (sum_neg - neg / 2.0)) / (sum(pos)::double * sum(neg)::double) as roc_auc
        from (select pos, neg, sum(neg) over (order by score) as sum_neg
              from (select score, sum(truth) as pos, sum(1 - truth) as neg
                    from scored group by score))""",
    "split": """
        select doc_id, quality,
               case when row_number() over (partition by quality order by md5('42:' || doc_id), doc_id)
                         <= quota then 'test' else 'train' end as split
        from labels join (
            select quality, least_rows
                   + (row_number() over (order by share - least_rows desc, quality)
                      <= test_rows - sum(least_rows) over ())::int as quota
            from (select quality, test_rows, n * test_rows / total as share,
                         floor(n * test_rows / total) as least_rows
                  from (select quality, count(*) as n, sum(count(*)) over () as total,
                               ceil(sum(count(*)) over () * 0.2::double) as test_rows
                        from labels group by quality))) as quotas using (quality)""",
    "chunked": f"""
        select doc_id, generate_subscripts(parts, 1) - 1 as number, unnest(parts) as chunk
        from (select doc_id, list_filter(list_transform(string_split(text, chr(10)),
                                                        lambda x: {strip("x")}),
                                         lambda x: x <> '') as parts
              from documents)""",
    "chunk_docs": """
        select 'glossary::' || doc_id || '::' || number as id, chunk as text,
               'glossary' as doc_type, string_split(chunk, chr(10))[1] as doc_name,
               null::varchar as doc_column
        from chunked""",
    "corpus": f"""
        select 'model::' || source as id, 'Model ' || source || ': ' || count(*) || ' documents' as text,
               'model' as doc_type, source as doc_name, null::varchar as doc_column
        from documents group by source
        union all
        select 'column::' || source || '.doc_' || doc_id,
               'Column doc_' || doc_id || ' in model ' || source || ': ' || {strip("text")},
               'column', source, 'doc_' || doc_id
        from documents
        union all select * from chunk_docs""",
    "centres": """
        select label, list(m order by i) as centre
        from (select label, i, avg(embedding[i]::double) as m
              from embeddings, unnest(range(1, len(embedding) + 1)) as position(i) group by label, i)
        group by label""",
    "neighbours": """
        select label as query_id, (row_number() over (
                   partition by label order by distance, vec_id))::int as rank,
               vec_id as id, distance
        from (select label, vec_id,
                     list_sum(list_transform(list_zip(v, centre),
                                             lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as distance
              from centres, (select vec_id, embedding::double[] as v from embeddings))
        qualify rank <= 5""",
    "labelled": "select wafer_id, is_fail from mart where is_fail is not null",
    "parted": """
        select wafer_id, is_fail,
               case when row_number() over (partition by is_fail order by md5('42:' || wafer_id), wafer_id)
                         <= quota then 'test' else 'train' end as split
        from labelled join (
            select is_fail, least_rows
                   + (row_number() over (order by share - least_rows desc, is_fail)
                      <= test_rows - sum(least_rows) over ())::int as quota
            from (select is_fail, test_rows, n * test_rows / total as share,
                         floor(n * test_rows / total) as least_rows
                  from (select is_fail, count(*) as n, sum(count(*)) over () as total,
                               ceil(sum(count(*)) over () * 0.2::double) as test_rows
                        from labelled group by is_fail))) as quotas using (is_fail)""",
    # Words as both engines find them, hashed by the first 32 bits of MD5.
    "slots": f"""
        select doc_id, ('0x' || substr(md5(word), 1, 8))::bigint % {DIMENSIONS} as slot, count(*) as n
        from (select doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) as word
              from documents) group by all""",
    "idf": """
        select slot, ln(((select count(*) from documents) + 1.0::double) / (count(*) + 1)) as w
        from slots group by slot""",
    "vectors": """
        select doc_id, slot, (n * w / sqrt(sum(n * w * n * w) over (partition by doc_id)))::float as weight
        from slots join idf using (slot) where w <> 0""",
    "asked": " union all ".join(
        f"select {number}::int as query_id, '{question}' as question"
        for number, question in enumerate(QUESTIONS)
    ),
    "asked_slots": f"""
        select query_id, slot, n * w as weight
        from (select query_id, ('0x' || substr(md5(word), 1, 8))::bigint % {DIMENSIONS} as slot,
                     count(*) as n
              from (select query_id,
                           unnest(regexp_extract_all(lower(question), '[\\p{{L}}\\p{{N}}_]+')) as word
                    from asked) group by all) join idf using (slot)""",
    "asked_vectors": """
        select query_id, slot,
               (weight / sqrt(sum(weight * weight) over (partition by query_id)))::float::double as weight
        from asked_slots""",
    # The squared distance from the parts of both vectors and of their product.
    "text_hits": """
        select query_id, (row_number() over (partition by query_id order by round(distance, 9), id))::int
                   as rank, id, doc_id, distance
        from (select query_id, 'doc::' || doc_id as id, doc_id,
                     any_value(asked_square) + coalesce(any_value(square), 0)
                         - 2 * coalesce(any_value(product), 0) as distance
              from documents
              cross join (select query_id, sum(weight * weight) as asked_square
                          from asked_vectors group by query_id)
              left join (select doc_id, sum(weight::double * weight::double) as square
                         from vectors group by doc_id) using (doc_id)
              left join (select query_id, doc_id, sum(a.weight * v.weight::double) as product
                         from asked_vectors a join vectors v using (slot) group by all)
                  using (query_id, doc_id)
              group by query_id, doc_id)
        qualify rank <= 5""",
}

READINGS = ["raw", "staged"]
RANKED = [*READINGS, "profile", "quality"]
IMPUTED = [*RANKED, "chosen", "kept", "medians", "imputed"]
LABELS = ["log", "tested"]
MART = [*IMPUTED, "features", *LABELS, "mart"]
SCORED = ["scored"]
CORPUS = ["chunked", "chunk_docs", "corpus"]
SEARCH = ["centres", "neighbours"]

QUALITY_COLUMNS = (
    "sensor_id, total_readings, non_null_readings, null_readings, null_pct,"
    " round(reading_stddev, 6) as reading_stddev, round(reading_mean, 6) as reading_mean,"
    f" sensor_rank, sensor_rank <= {CONFIG.top_sensors} as is_selected_for_ml"
)


def query(steps: list[str], select: str) -> str:
    if not steps:
        return select
    named = ",\n".join(f"{step} as ({STEPS[step]})" for step in steps)
    return f"with {named}\n{select}"


def _suite() -> str:
    views = {
        "staged_readings": "staged",
        "staged_labels": "tested",
        "sensor_quality": "quality",
        "wafer_features": "features",
        "daily_yield": "daily",
        "yield_summary": "overall",
        "ml_features": "mart",
    }
    parts = []
    for check in PIPELINE_CHECKS:
        view, column = views[check.table], check.column
        if check.kind == "not_null":
            failures = f"select count(*) from {view} where {column} is null"
        elif check.kind == "unique":
            failures = (
                f"select count(*) from (select {column} from {view} where {column} is not null"
                f" group by {column} having count(*) > 1)"
            )
        else:
            accepted = ", ".join(repr(value) for value in check.values)
            failures = f"select count(distinct {column}) from {view} where {column} not in ({accepted})"
        parts.append(f"select '{check.name}' as test, ({failures}) as failures")
    return "\nunion all ".join(parts)


def _wide() -> str:
    cells = ", ".join(f"cells[{i}] as {name}" for i, name in enumerate(sensor_names(CHANNELS), start=1))
    return f"select row_number() over (order by wafer_id, cells) as wafer_id, {cells} from matrix"


def _wide_features() -> str:
    cells = ", ".join(
        f"ifnull(nullif(cells[ids[{rank}]], {CONFIG.sentinel}::double), fills[{rank}]) as {name}"
        for rank, name in enumerate(FEATURES, start=1)
    )
    gaps = f"len(list_filter(ids, lambda i: cells[i] = {CONFIG.sentinel}::double))"
    return f"""
        select wafer_id, ({gaps} > 0)::int as any_imputed_flag, {gaps} as imputed_sensor_count, {cells}
        from matrix, picks"""


def _averages() -> str:
    scores = ", ".join(f"round({{}}({m}), 6)" for m in "prf")
    weighted = ", ".join(f"round(sum({m} * n) / sum(n), 6)" for m in "prf")
    return f"""
        select c::varchar as label, round(p, 6) as precision, round(r, 6) as recall,
               round(f, 6) as f1_score, n as support from per_class
        union all select 'accuracy', null, null, round(sum(hits)::double / sum(n), 6),
                         sum(n)::bigint from per_class
        union all select 'macro avg', {scores.format("avg", "avg", "avg")}, sum(n)::bigint from per_class
        union all select 'weighted avg', {weighted}, sum(n)::bigint from per_class"""


_QUOTED = "case when pass_fail_raw = 0 then '' else '\"' end"
_LINES = [*LABELS[:1]]

ORACLE_SQL: dict[str, str] = {
    "read_matrix": query(["matrix"], _wide()),
    "row_ordinal": query(
        _LINES,
        f"""select row_number() over (order by wafer_id) as row_number,
                   pass_fail_raw || ' ' || {_QUOTED} || timestamp_str || {_QUOTED} as value
            from log""",
    ),
    "parse_labels": query(
        _LINES,
        """select row_number() over (order by wafer_id) as wafer_id, pass_fail_raw,
                  case when pass_fail_raw = 0 then string_split(timestamp_str, ' ')[1]
                       else timestamp_str end as timestamp_str
           from log""",
    ),
    "bronze_write": query(
        ["raw", "log"],
        """select (select count(*) from embeddings) as wafer_count, count(*) as reading_count,
                  count(distinct sensor_id) as sensor_count,
                  (select count(*) from log) as label_count from raw""",
    ),
    "ingest_audit": query(
        ["raw"],
        """select (select count(*) from embeddings) as wafer_count, count(*) as reading_count,
                  count(distinct sensor_id) as sensor_count from raw""",
    ),
    "melt_long": query(["raw"], "from raw"),
    "nullify_sentinel": query(READINGS, "from staged"),
    "channel_quality": query(RANKED, f"select {QUALITY_COLUMNS} from quality"),
    "selected_channels": query([*RANKED, "chosen"], "from chosen"),
    "selected_readings": query([*RANKED, "chosen", "kept"], "from kept"),
    "median_impute": query(
        IMPUTED, "select wafer_id, sensor_id, reading_value, was_imputed from imputed"
    ),
    "wafer_features": query([*IMPUTED, "features"], "from features"),
    "wafer_features_wide": query([*RANKED, "chosen", "medians", "picks", "matrix"], _wide_features()),
    "ml_features": query(MART, "from mart"),
    "mart_read": query(MART, "from mart order by wafer_id"),
    "label_staging": query(LABELS, "from tested"),
    "daily_yield": query([*LABELS, "daily"], "from daily order by test_date"),
    "streamed_labels": query(
        ["log", "keyed"],
        """select case when readable then wafer_id end as wafer_id,
                  case when readable then pass_fail_raw end as pass_fail_raw,
                  case when readable then timestamp_str end as timestamp_str, readable,
                  case when not readable
                       then wafer_id || chr(9) || 'none "' || timestamp_str || '"' end as value
           from keyed""",
    ),
    "streamed_daily_yield": query(
        [*LABELS, "timed", "marks", "in_time", "closed"],
        "select closed.* from closed, marks where test_date + interval 1 day <= final",
    ),
    "yield_summary": query([*LABELS, "overall"], "from overall"),
    "dq_not_null": query(
        LABELS,
        """select unnest(['wafer_id', 'yield_status', 'is_fail', 'tested_at']) as column_name,
                  unnest([count(*) - count(wafer_id), count(*) - count(yield_status),
                          count(*) - count(is_fail), count(*) - count(tested_at)]) as failures
           from tested""",
    ),
    "dq_unique": """select l_orderkey, l_linenumber, count(*) as n_records from lineitem
                    group by all having count(*) > 1""",
    "dq_accepted_values": query(
        LABELS,
        """select yield_status as value, count(*) as n_records from tested
           where yield_status not in ('pass', 'fail') group by all""",
    ),
    "dq_report": query([*MART, "daily", "overall"], _suite()),
    "confusion_matrix": query(
        SCORED,
        """select t as truth, p as prediction,
                  count(*) filter (where scored.truth = t and scored.prediction = p) as n
           from scored, (values (0), (1)) as a(t), (values (0), (1)) as b(p) group by t, p""",
    ),
    "binary_prf": query(
        [*SCORED, "per_class"],
        """select round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1_score
           from per_class where c = 1""",
    ),
    "classification_report": query([*SCORED, "per_class"], _averages()),
    "roc_auc": query([*SCORED, "auc"], "select round(roc_auc, 6) as roc_auc from auc"),
    "label_profile": query(
        ["split"],
        f"""select count(*) as rows_total, count(*) filter (where split = 'train') as rows_train,
                   count(*) filter (where split = 'test') as rows_test,
                   {pct("sum(quality)", "count(quality)")} as positive_rate_pct from split""",
    ),
    "stratified_split": query(["split"], "from split"),
    "hashed_split": """
        select doc_id, quality,
               case when quality is null then null
                    when ('0x' || substr(md5('42:' || doc_id), 1, 8))::bigint < round(0.2 * 4294967296)
                    then 'test' else 'train' end as split
        from labels""",
    "class_weights": """
        select quality, count(*) as class_rows,
               round(sum(count(*)) over ()::double / (count(*) over () * count(*)), 6) as class_weight
        from labels group by quality""",
    "metrics_record": query(
        [*SCORED, "per_class", "auc"],
        f"""select count(*) as rows_total, {pct("sum(truth)", "count(truth)")} as positive_rate_pct,
                   (select round(f, 4) from per_class where c = 1) as f1_fail_class,
                   (select round(roc_auc, 4) from auc) as roc_auc,
                   (select round(p, 4) from per_class where c = 1) as precision_fail,
                   (select round(r, 4) from per_class where c = 1) as recall_fail,
                   format('[[{{}},{{}}],[{{}},{{}}]]',
                          count(*) filter (where truth = 0 and prediction = 0),
                          count(*) filter (where truth = 0 and prediction = 1),
                          count(*) filter (where truth = 1 and prediction = 0),
                          count(*) filter (where truth = 1 and prediction = 1)) as confusion_matrix,
                   round(avg((truth = prediction)::int), 6) as accuracy
            from scored""",
    ),
    "catalog_docs": f"""
        with entries as (
            select 'doc_' || doc_id as name, source, string_split(text, chr(10)) as lines from documents),
        fields as (
            select name, 'line_' || printf('%03d', generate_subscripts(lines, 1)) as field,
                   unnest(lines) as line from entries)
        select 'model::' || name as id, 'Model ' || name || ': ' || {strip("source")} as text,
               'model' as doc_type, name as doc_name, null::varchar as doc_column from entries
        union all
        select 'column::' || name || '.' || field,
               'Column ' || field || ' in model ' || name || ': ' || {strip("line")},
               'column', name, field from fields""",
    "doc_chunks": query(CORPUS[:2], "from chunk_docs"),
    "catalog_corpus": query(CORPUS, "from corpus"),
    "index_manifest": query(
        CORPUS,
        f"""select '{COLLECTION}' as collection, count(*) as document_count,
                   '{ENCODER}' as embedding_model from corpus""",
    ),
    "knn_approximate": f"""
        select vec_id as query_id, least({NEIGHBOURS}, (select count(*) - 1 from embeddings)) as neighbours,
               true as distances_hold, true as recall_reached
        from embeddings where vec_id % 20 = 0""",
    "knn_search": query(
        SEARCH, "select query_id, rank, id, round(distance, 6) as distance from neighbours"
    ),
    "search_hits": query(
        SEARCH,
        """select query_id, rank, id, text as document, source, round(distance, 6) as distance,
                  '[' || case when lang = 'en' then 'doc' else lang end || '] '
                      || substring(text, 1, 220) || '...' as headline,
                  printf('%.4f', distance) as distance_text
           from neighbours join documents on doc_id = id""",
    ),
}
TRAINED = [*MART, "labelled", "parted"]
EMBEDDED = ["slots", "idf", "vectors"]
ORACLE_SQL |= {
    "index_rebuild": """
        select lang, count(*) as documents, any_value(english) as first_seen, any_value(n) as last_seen,
               any_value(english + n) as stored, 2::bigint as versions
        from documents, (select count(*) as n, count(*) filter (where lang = 'en') as english from documents)
        group by lang""",
    "distinct_users": """
        select ts::date as day, count(distinct user_id) as users, true as within_bound,
               true as merged_equals_one_pass from events group by 1
        union all select null, count(distinct user_id), true, true from events""",
    "feature_stamp": query(MART, f"select wafer_id, timestamp '{BUILT_AT}' as feature_set_built_at from mart"),
    "feature_columns": query(
        MART,
        " union all ".join(
            f"select {place}::int as place, '{name}' as feature, count({name}) as filled from mart"
            for place, name in enumerate(FEATURES, start=1)
        ),
    ),
    "published_marts": f"""
        with log as (
            select row_number() over (order by event_id) as wafer_id, ts::date as test_date,
                   (event_type = 'error')::int as is_fail from events),
        both_known as (select * from log where wafer_id <= (select count(*) from embeddings))
        select test_date, count(*) as wafer_count, sum(is_fail)::bigint as fail_count,
               (count(*) - sum(is_fail))::bigint as pass_count,
               {pct("sum(is_fail)", "count(*)")} as fail_rate_pct,
               {pct("count(*) - sum(is_fail)", "count(*)")} as yield_rate_pct,
               (select count(*) from both_known) as feature_rows,
               (select sum(is_fail)::bigint from both_known) as feature_fails,
               (select count(*) from log) as total_wafers
        from log group by test_date""",
    "train_forest": query(
        TRAINED,
        f"""select count(*) filter (where split = 'train') as train_rows, {TREES}::bigint as trees,
                   count(distinct is_fail) as classes, {len(FEATURES)}::bigint as features,
                   true as within_depth from parted""",
    ),
    "score_batch": query(
        TRAINED,
        """select wafer_id, is_fail, true as is_probability, true as agrees
           from parted where split = 'test'""",
    ),
    "model_roundtrip": query(
        TRAINED,
        "select wafer_id, 2::bigint as scorings, 1::bigint as results from parted where split = 'test'",
    ),
    "guard_report": """
        select * from (values ('missing_file', 'FileNotFoundError', true), ('absent_table', 'RuntimeError', true),
            ('empty_table', 'RuntimeError', true), ('failing_checks', 'DataQualityError', true))
            as guards(guard, stopped_by, marts_unchanged)""",
    "embed_external": f"""
        select doc_id, slot::int as place, round((count(*) / any_value(words)::double)::float::double, 5) as weight
        from (select doc_id, len(string_split(text, ' ')) as words,
                     ('0x' || substr(md5(unnest(string_split(text, ' '))), 1, 8))::bigint % {HOOK_WIDTH} as slot
              from documents) group by doc_id, slot""",
    "top_features": query(
        MART,
        """select count(distinct wafer_id) * 0 + 10 as names, true as all_features,
                  true as all_shares, true as descending, true as parts_of_one from mart""",
    ),
    "embed_text": query(
        EMBEDDED,
        "select doc_id, slot::int as place, round(weight::double, 5) as weight from vectors where weight <> 0",
    ),
    "text_search": query(
        [*EMBEDDED, "asked", "asked_slots", "asked_vectors", "text_hits"],
        """select query_id, rank, id, text as document, round(distance, 5) as distance,
                  '[doc] ' || substring(text, 1, 220) || '...' as headline
           from text_hits join documents using (doc_id)""",
    ),
}
for _name in ("channel_median", "channel_median_counted", "channel_median_sketched"):
    ORACLE_SQL[_name] = query(
        [*READINGS, "medians"],
        "select sensor_id, sensor_median from medians",
    )
