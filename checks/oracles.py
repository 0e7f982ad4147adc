"""The same queries in SQL, written from the definitions rather than from the
operators: plain windows, self-contained subqueries, no buckets."""

from __future__ import annotations

import re

from checks.standins import EVENT_WINDOW_DAYS, HOME, STATE_CODES, STOP_WORDS
from tallyshore.schemas import DATASET_COLUMNS, US_STATES

_CODES = ", ".join(f"'{c}'" for c in STATE_CODES)
_STATES = ", ".join(f"'{c}'" for c in US_STATES)
_MICROS = "'%Y-%m-%d %H:%M:%S.%f'"
# whitespace as Java counts it; RE2 leaves out the vertical tab
_SPACE = r"[ \t\n\x0B\f\r]+"

# The check tables in the shape the operators expect, and shared steps. A query
# gets those it names, with what they build on.
CTE = {
    "users": """
        select c_custkey as id,
               cast(case when c_custkey % 17 <> 0 then 18 + c_custkey % 55 end as int) as age,
               case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
               n_name as state, r_name as country, c_mktsegment as traffic_source
        from customer join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "home": f"select * from users where country = '{HOME}'",
    "shop_orders": """
        select o_orderkey as order_id, o_custkey as user_id,
               case o_orderstatus when 'F' then 'Complete' when 'O' then 'Shipped'
                    else 'Cancelled' end as status,
               o_orderdate as created_at,
               cast(1 + floor(o_totalprice / 100000) as int) as num_of_item
        from orders""",
    "order_items": """
        select l_orderkey * 10 + l_linenumber as id, o_custkey as user_id,
               l_partkey as product_id,
               case when l_returnflag = 'R' then 'Returned' when o_orderstatus = 'P'
                    then 'Cancelled' else 'Complete' end as status,
               o_orderdate as created_at, l_extendedprice * (1 - l_discount) as sale_price
        from lineitem join orders on l_orderkey = o_orderkey""",
    "shop_events": """
        select event_id as id, user_id,
               user_id || '-' || strftime(ts, '%Y-%m-%d') as session_id,
               ts as created_at, event_type
        from events""",
    "complaints": f"""
        select case when doc_id % 10 = 9 then doc_id - 1 else doc_id end as complaint_id,
               case when doc_id % 97 <> 0 then date '2020-01-01' + cast(doc_id * 7 % 1500 as int)
               end as date_received,
               lang as product, ([{_CODES}])[doc_id % {len(STATE_CODES)} + 1] as state,
               text as narrative
        from documents""",
    "order_complaints": """
        select o_orderkey as complaint_id,
               case when o_orderkey % 101 <> 0 then cast(o_orderdate as date) end as date_received,
               o_orderpriority as product,
               case when o_custkey % 50 = 0 then 'ZZ'
                    else 'S' || lpad(cast(c_nationkey as varchar), 2, '0') end as state
        from orders join customer on o_custkey = c_custkey""",
    "valid": """
        select * from shop_orders
        where status in ('Complete', 'Shipped', 'Processing', 'Returned')""",
    "cut": "select max(created_at) - interval 180 days as cut_at from valid",
    "event_cut": f"""
        select max(created_at) - interval {EVENT_WINDOW_DAYS} days as cut_at from shop_events""",
    "churn_labels": """
        select b.user_id, cast(case when a.user_id is null then 1 else 0 end as int) as churned
        from (select distinct user_id from valid, cut where created_at <= cut_at) b
        left join (select distinct user_id from valid, cut where created_at > cut_at) a
        on a.user_id = b.user_id""",
    "order_feat": """
        select user_id, count(order_id) as order_count,
               cast(date_diff('day', max(created_at), any_value(cut_at)) as int) as recency_days,
               cast(date_diff('day', min(created_at), any_value(cut_at)) as int) as tenure_days,
               count(*) filter (where created_at >= cast(cut_at as date) - 365) as orders_last_365d,
               avg(num_of_item) as avg_items_per_order
        from valid, cut where created_at <= cut_at group by user_id""",
    "spend_feat": """
        select user_id,
               cast(round(sum(cast(sale_price as decimal(18,6))), 2) as double) as total_spent,
               round(cast(sum(cast(sale_price as decimal(18,6))) as double) / count(*), 2)
                   as avg_item_price,
               count(i.id) as items_bought, count(distinct p_type) as distinct_categories,
               avg(case when status = 'Returned' then 1 else 0 end) as return_rate
        from order_items i cross join cut left join part on product_id = p_partkey
        where created_at <= cut_at and status <> 'Cancelled' group by user_id""",
    "event_feat": """
        select user_id, count(distinct session_id) as session_count,
               cast(count(id) as double) / count(distinct session_id) as avg_events_per_session,
               cast(date_diff('day', max(created_at), any_value(cut_at)) as int)
                   as days_since_last_visit,
               count(*) filter (where event_type = 'purchase') as cart_events
        from shop_events, event_cut where created_at <= cut_at group by user_id""",
    "dataset": f"""
        select * from (
            select l.user_id, l.churned, age, gender, state, traffic_source, order_count,
                   recency_days, tenure_days, orders_last_365d, avg_items_per_order,
                   coalesce(total_spent, 0) as total_spent, avg_item_price,
                   coalesce(items_bought, 0) as items_bought,
                   coalesce(distinct_categories, 0) as distinct_categories,
                   coalesce(return_rate, 0) as return_rate,
                   coalesce(session_count, 0) as session_count,
                   coalesce(avg_events_per_session, 0) as avg_events_per_session,
                   days_since_last_visit, coalesce(cart_events, 0) as cart_events
            from churn_labels l join home on home.id = l.user_id
            left join order_feat o on o.user_id = l.user_id
            left join spend_feat s on s.user_id = l.user_id
            left join event_feat e on e.user_id = l.user_id)""",
    "gaps": """
        select user_id, created_at, prev_order_at,
               cast(date_diff('day', prev_order_at, created_at) as int) as gap_days
        from (select user_id, created_at, lag(created_at) over
                     (partition by user_id order by created_at) as prev_order_at from valid)
        where prev_order_at is not null""",
    "cleaned": rf"""
        select complaint_id, date_received, product, state, narrative from (
            select *, row_number() over (partition by complaint_id order by
                       date_received desc nulls last, md5(concat_ws('|',
                       coalesce(cast(date_received as varchar), ''), product, state, narrative))
                       desc) as rn
            from (select complaint_id, date_received, product, state, regexp_replace(
                         regexp_replace(narrative, 'X{{2,}}[\d/]*', ' ', 'g'),
                         '{_SPACE}', ' ', 'g') as narrative
                  from complaints
                  where narrative is not null and product is not null and state in ({_STATES}))
            where length(narrative) >= 100)
        where rn = 1""",
    "sample": """
        select complaint_id, product, state, narrative from cleaned
        where ('0x' || substr(md5('42|' || complaint_id), 1, 15))::bigint < (1::bigint << 60) // 10""",
    "stats": """
        select state, product, date_trunc('month', cast(date_received as timestamp)) as month,
               count(complaint_id) as complaint_count
        from order_complaints group by all""",
    "scores": """
        select l.user_id, case when l.user_id % 40 = 0 then 'Nowhere' else state end as state,
               churned, (l.user_id * 7919 % 1000) / cast(1000 as double) as churn_probability,
               case l.user_id % 5 when 0 then 'test' when 1 then 'validation' else 'train' end
                   as split
        from churn_labels l join home on home.id = l.user_id""",
    "scored_documents": """
        select doc_id, quality as label,
               ((n_chars * 31 + doc_id) % 997) / cast(997 as double) as probability,
               case when ((n_chars * 31 + doc_id) % 997) / cast(997 as double) >= 0.5
                    then 1 else 0 end as prediction
        from labels join documents using (doc_id)""",
    "guesses": """
        select lang as label, case when doc_id % 5 = 0 or lang = 'es' then 'en'
               when doc_id % 7 = 0 then 'fr' else lang end as prediction
        from documents""",
    "class_scores": """
        select name, support, case when guessed = 0 then 0 else hits / guessed end as precision,
               hits / support as recall,
               case when hits = 0 then 0 else 2.0 * hits / (guessed + support) end as f1, hits
        from (select c.name,
                     cast(count(*) filter (where label = c.name) as double) as support,
                     cast(count(*) filter (where prediction = c.name) as double) as guessed,
                     cast(count(*) filter (where label = c.name and prediction = c.name)
                          as double) as hits
              from (select distinct label as name from guesses) c, guesses group by c.name)""",
    "dim_state": """
        select cast(row_number() over (order by state_code) as int) as state_sk, * from (
            select 'S' || lpad(cast(n_nationkey as varchar), 2, '0') as state_code,
                   n_name as state_name from nation)""",
    "dim_product": """
        select cast(row_number() over (order by product) as int) as product_sk,
               product as product_name
        from (select distinct product from stats where product is not null)""",
    "dim_date": """
        select cast(strftime(d, '%Y%m%d') as int) as date_sk, d as full_date,
               cast(year(d) as int) as year, cast(month(d) as int) as month,
               monthname(d) as month_name
        from (select cast(month as date) as d from stats where month is not null
              union select cast(cut_at as date) from cut)""",
    "dim_customer": """
        select row_number() over (order by l.user_id) as user_sk, l.user_id, age,
               case when age is null then 'unknown' when age < 25 then 'under 25'
                    when age < 35 then '25-34' when age < 50 then '35-49' else '50 plus' end
                   as age_group, gender, traffic_source
        from churn_labels l join home on home.id = l.user_id""",
    "churn_keys": """
        select user_sk, state_sk, cast(strftime(cut_at, '%Y%m%d') as int) as date_sk,
               churn_probability, churned, split
        from scores cross join cut left join dim_customer using (user_id)
        left join dim_state on state = state_name""",
    "complaint_keys": """
        select state_sk, product_sk, cast(strftime(month, '%Y%m%d') as int) as date_sk,
               complaint_count
        from stats left join dim_state on state = state_code
        left join dim_product on product = product_name""",
    "fact_churn": "select * from churn_keys where user_sk is not null and state_sk is not null",
    "fact_comp": """
        select * from complaint_keys
        where state_sk is not null and product_sk is not null and date_sk is not null""",
}


def with_steps(body: str) -> str:
    """Puts the steps a query names, and those they name, in front of it."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in CTE:
            if name not in needed and re.search(rf"(?<![.\w']){name}\b(?!')", sql):
                visit(CTE[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "with " + ", ".join(f"{n} as ({CTE[n]})" for n in needed) + "\n" + body


def _split(source: str, id_col: str, stratum: str, cuts: dict[str, int], last: str) -> str:
    cases = " ".join(f"when r <= (n * {permille} + 999) // 1000 then '{name}'"
                     for name, permille in cuts.items())
    return f"""
        select {id_col}, {stratum}, case {cases} else '{last}' end as split
        from (select *, row_number() over (partition by {stratum}
                     order by md5('42|' || {id_col})) as r,
                     count(*) over (partition by {stratum}) as n from {source})"""


def _ranking(source: str, label: str, score: str, by: str = "") -> str:
    over = f"partition by {by}" if by else ""
    key = f"{by}," if by else ""
    group = f"group by {by}" if by else ""
    return f"""
        select {key}
               round(sum(neg * (cum_pos - pos / 2)) / (any_value(p) * any_value(q)), 4) as roc_auc,
               round(sum(pos / p * cum_pos / (cum_pos + cum_neg)), 4) as pr_auc
        from (select *, sum(pos) over (w) as cum_pos, sum(neg) over (w) as cum_neg,
                     sum(pos) over ({over}) as p, sum(neg) over ({over}) as q
              from (select {key} {score},
                           cast(count(*) filter (where {label} = 1) as double) as pos,
                           cast(count(*) filter (where {label} = 0) as double) as neg
                    from {source} group by {key} {score})
              window w as ({over} order by {score} desc))
        {group}"""


_PERCENTS = ", ".join(
    f"min(gap_days) filter (where r >= ceil({p} * n / 100.0)) as p{p}"
    for p in (25, 50, 75, 80, 90, 95))

_FOREIGN = {
    ("fact_churn_prediction", "user_sk"), ("fact_churn_prediction", "state_sk"),
    ("fact_churn_prediction", "date_sk"), ("fact_complaints", "state_sk"),
    ("fact_complaints", "product_sk"), ("fact_complaints", "date_sk"),
}

_BODIES = {
    "churn_by_state": """
        select state, count(*) as customers, count(*) filter (where churned = 1) as churned,
               avg(churned) as churn_rate
        from churn_labels join users on users.id = user_id group by state""",
    "cutoff_date": f"select strftime(cut_at, {_MICROS}) as cutoff from cut",
    "valid_orders": f"""
        select order_id, user_id, status, strftime(created_at, {_MICROS}) as created_at,
               num_of_item from valid""",
    "churn_label": "select * from churn_labels",
    "window_sweep": """
        select cast(d as int) as window_days, count(*) filter (where last <= cut_at) as churned,
               count(*) filter (where last > cut_at) as retained,
               cast(count(*) filter (where last <= cut_at) as double) / count(*) as churn_rate
        from (select d, max(created_at) - to_days(cast(d as int)) as cut_at
              from valid, (values (90), (180), (365)) t(d) group by d),
             (select user_id, min(created_at) as first, max(created_at) as last
              from valid group by user_id)
        where first <= cut_at group by d""",
    "order_gaps": f"""
        select user_id, strftime(created_at, {_MICROS}) as created_at,
               strftime(prev_order_at, {_MICROS}) as prev_order_at, gap_days from gaps""",
    "gap_percentiles": f"""
        select {_PERCENTS}
        from (select gap_days, row_number() over (order by gap_days) as r,
                     count(*) over () as n from gaps)""",
    "gap_histogram": """
        select cast(bin as int) as bin, round(lo + (bin - 1) * (hi - lo) / 80.0, 6) as low,
               round(lo + bin * (hi - lo) / 80.0, 6) as high,
               count(gap_days) as gaps
        from (select cast(min(gap_days) as double) as lo, cast(max(gap_days) as double) as hi
              from gaps)
        cross join range(1, 81) t(bin) left join gaps
        on least(80, 1 + floor((gap_days - lo) * 80 / (hi - lo))) = bin
        group by bin, lo, hi""",
    "home_users": "select id as user_id, age, gender, state, traffic_source from home",
    "order_features": "select * from order_feat",
    "spend_features": "select * from spend_feat",
    "event_features": "select * from event_feat",
    "churn_dataset": f"select {', '.join(DATASET_COLUMNS)} from dataset",
    "dataset_summary": """
        select count(*) as customers, count(*) filter (where churned = 1) as churned,
               avg(churned) as churn_rate from churn_labels join home on home.id = user_id""",
    "table_rows": " union all ".join(
        f"select '{n}' as table_name, count(*) as rows from {n}"
        for n in ("customer", "orders", "lineitem", "part", "events", "documents")),
    "users_by_country": "select country, count(*) as rows from users group by country",
    "home_users_by_state_top15": """
        select state, count(*) as rows from users group by state
        order by rows desc, state limit 15""",
    "orders_by_status": "select status, count(*) as rows from shop_orders group by status",
    "order_date_range": f"""
        select strftime(min(created_at), {_MICROS}) as first_order,
               strftime(max(created_at), {_MICROS}) as last_order from shop_orders""",
    "null_audit": " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) as rows, "
        f"count(*) filter (where {c} is null) as nulls from {source}"
        for t, source, columns in (
            ("users", "users", ("id", "age", "country", "state")),
            ("orders", "shop_orders", ("order_id", "user_id", "status", "created_at")),
            ("complaints", "complaints", ("complaint_id", "date_received", "state")))
        for c in columns),
    "narrative_coverage": "select count(*) as rows, count(narrative) as with_value from complaints",
    "distinct_products": "select distinct p_type as category from part",
    "distinct_product_count": "select count(distinct p_type) as distinct_values from part",
    "clean_complaints": """
        select complaint_id, strftime(date_received, '%Y-%m-%d') as date_received, product, state,
               narrative from cleaned""",
    "newest_order_per_customer": f"""
        select order_id, user_id, status, strftime(created_at, {_MICROS}) as created_at,
               num_of_item
        from (select *, row_number() over (partition by user_id order by created_at desc,
                        md5(concat_ws('|', order_id, status,
                            strftime(created_at, '%Y-%m-%d %H:%M:%S'), num_of_item)) desc) as rn
              from shop_orders)
        where rn = 1""",
    "complaint_sample": "select * from sample",
    "narrative_peek": """
        select complaint_id, product, state, substr(narrative, 1, 400) as narrative
        from sample order by md5('7|' || complaint_id) limit 3""",
    "complaint_months": f"""
        select state, product,
               strftime(date_trunc('month', cast(date_received as timestamp)), {_MICROS}) as month,
               count(complaint_id) as complaint_count
        from cleaned group by all""",
    "order_months": f"""
        select state, product, strftime(month, {_MICROS}) as month, complaint_count from stats""",
    "recoded_products": """
        select case product when 'fr' then 'romance' when 'es' then 'romance'
                    when 'de' then 'germanic' else product end as product, count(*) as rows
        from complaints group by 1""",
    "complaint_totals_by_state_top15": """
        select state, count(*) as complaints from order_complaints group by state
        order by complaints desc, state limit 15""",
    "churn_split": _split("churn_labels", "user_id", "churned", {"train": 600, "validation": 800}, "test"),
    "topic_split": _split("(select doc_id, lang as product from documents)", "doc_id", "product",
                          {"train": 800}, "test"),
    "class_weights": """
        select product, count(*) as rows,
               cast((select count(*) from complaints) as double)
               / ((select count(distinct product) from complaints) * count(*)) as weight
        from complaints group by product""",
    "tiny_sample": """
        select l_orderkey, l_linenumber from lineitem
        where ('0x' || substr(md5('42|' || l_orderkey), 1, 15))::hugeint * 100000 < (1::hugeint << 60) * 37""",
    "uneven_split": """
        select k, l_returnflag, case when r <= ceil(n * 9996::decimal(19, 0) / 10000) then 'train' else 'test' end as split
        from (select *, row_number() over (partition by l_returnflag order by md5('42|' || k)) as r,
                     count(*) over (partition by l_returnflag) as n
              from (select l_orderkey * 8 + l_linenumber as k, l_returnflag from lineitem))""",
    "tiny_top_share": """
        select k, l_extendedprice
        from (select *, row_number() over (order by l_extendedprice desc, md5('42|' || k)) as r, count(*) over () as n
              from (select l_orderkey * 8 + l_linenumber as k, l_extendedprice from lineitem))
        where r <= (n * 4 + 9999) // 10000""",
    "budget_targets": """
        select user_id, state, churned, churn_probability, split
        from (select *, row_number() over (order by churn_probability desc,
                        md5('42|' || user_id)) as r, count(*) over () as n from scores)
        where r <= ceil(0.2 * n)""",
    "ranking_metrics": _ranking("scored_documents", "label", "probability"),
    "ranking_metrics_by_split": _ranking("scores", "churned", "churn_probability", "split"),
    "baseline_metrics": """
        select 0.5::double as roc_auc, round(avg(label), 4) as pr_auc from scored_documents""",
    "baseline_predictions": """
        select 'always_churn_baseline' as model, 0.5::double as roc_auc, round(avg(churned), 4) as pr_auc
        from scores where split = 'validation'""",
    "best_language": "select * from (" + _ranking(
        "(select s.*, lang as model from scored_documents s join documents using (doc_id))",
        "label", "probability", "model") + """)
        where model <> 'en' order by nullif(roc_auc, 'nan'::double) desc nulls last, model limit 1""",
    "served_tables": " union all ".join(
        f"select '{t}' as table_name, count(*) as rows from {t}" for t in ("nation", "customer", "orders", "lineitem")),
    "json_report": """
        select label as actual, prediction as predicted, count(*) as rows
        from scored_documents group by all""",
    "redacted_texts": rf"""
        select doc_id, regexp_replace(regexp_replace(replace(text, 'e ', 'XXXX12/3 '),
            'X{{2,}}[\d/]*', ' ', 'g'), '{_SPACE}', ' ', 'g') as narrative from documents""",
    "confusion_matrix": """
        select label as actual, prediction as predicted, count(*) as rows
        from scored_documents group by all""",
    "classification_report": """
        select name, round(precision, 6) as precision, round(recall, 6) as recall,
               round(f1, 6) as f1, cast(support as bigint) as support
        from (select name, precision, recall, f1, support from class_scores
              union all select 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support),
                     sum(hits) / sum(support), sum(support) from class_scores
              union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)
              from class_scores
              union all select 'weighted avg', sum(precision * support) / sum(support),
                     sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                     sum(support) from class_scores)""",
    "macro_f1": "select round(avg(f1), 6) as macro_f1 from class_scores",
    "score_histogram": """
        with held as (select churned, churn_probability as x from scores where split = 'test'),
        span as (select churned, min(x) as lo, max(x) as hi, count(*) as n from held
                 group by churned)
        select span.churned, cast(bin as int) as bin,
               round(lo + (bin - 1) * (hi - lo) / 50, 6) as low,
               round(lo + bin * (hi - lo) / 50, 6) as high, count(x) as rows,
               round(count(x) / (n * (hi - lo) / 50), 6) as density
        from span cross join range(1, 51) t(bin) left join held
        on held.churned = span.churned and least(50, 1 + floor((x - lo) * 50 / (hi - lo))) = bin
        group by span.churned, bin, lo, hi, n""",
    "dim_state": "select * from dim_state",
    "dim_product": "select * from dim_product",
    "dim_date": """
        select date_sk, strftime(full_date, '%Y-%m-%d') as full_date, year, month, month_name
        from dim_date""",
    "dim_customer": "select * from dim_customer",
    "fact_churn_prediction": "select * from fact_churn",
    "fact_complaints": "select * from fact_comp",
    "star_load_summary": """
        select 'dim_state' as table_name, count(*) as rows, 0::bigint as dropped from dim_state
        union all select 'dim_product', count(*), 0 from dim_product
        union all select 'dim_date', count(*), 0 from dim_date
        union all select 'dim_customer', count(*), 0 from dim_customer
        union all select 'fact_churn_prediction', (select count(*) from fact_churn),
               count(*) - (select count(*) from fact_churn) from churn_keys
        union all select 'fact_complaints', (select count(*) from fact_comp),
               count(*) - (select count(*) from fact_comp) from complaint_keys""",
    "age_groups": """
        select p_partkey, p_size as age,
               case when p_size is null then 'unknown' when p_size < 25 then 'under 25'
                    when p_size < 35 then '25-34' when p_size < 50 then '35-49'
                    else '50 plus' end as age_group
        from part""",
    "date_keys": """
        select cast(strftime(o_orderdate, '%Y%m%d') as int) as date_sk,
               cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
               monthname(o_orderdate) as month_name, count(*) as rows
        from orders group by all""",
    "churn_headline": """
        select count(*) as customers, avg(churned) as churn_rate,
               round(avg(churn_probability), 6) as avg_probability from fact_churn""",
    "churn_headline_by_split": """
        select split, count(*) as customers, avg(churned) as churn_rate,
               round(avg(churn_probability), 6) as avg_probability from fact_churn group by split""",
    "complaint_headline": """
        select cast(sum(complaint_count) as bigint) as complaints from fact_comp""",
}

_NUMBERS = [c for c in DATASET_COLUMNS
            if c not in ("user_id", "churned", "gender", "state", "traffic_source")]
# a column without spread scales to 0
_BODIES["model_inputs"] = (
    "with filled as (select user_id, gender, "
    + ", ".join(f"cast(coalesce({c}, median({c}) over ()) as double) as {c}" for c in _NUMBERS)
    + " from dataset) select user_id, "
    "case when gender = 'F' then 1.0 else 0.0 end as gender_f, "
    "case when gender = 'M' then 1.0 else 0.0 end as gender_m, "
    + ", ".join(f"round(coalesce(({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0), "
                f"0), 6) + 0.0 as {c}" for c in _NUMBERS)
    + " from filled")
_BODIES["csv_round_trip"] = f"""
    select id, user_id, session_id, strftime(created_at, {_MICROS}) as created_at, event_type
    from shop_events"""
_BODIES["complaints_round_trip"] = """
    select complaint_id, strftime(date_received, '%Y-%m-%d') as date_received, product, state,
           narrative from complaints"""
_BODIES["imputation_medians"] = " union all ".join(
    f"select '{c}' as column_name, median({c}) as median from lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


def _vocabulary(stop_words) -> str:
    stops = ", ".join(f"'{w}'" for w in stop_words)
    return rf"""
        with words as (
            select complaint_id as doc_id, list_filter(regexp_extract_all(lower(narrative), '[\p{{L}}\p{{N}}_]{{2,}}'),
                                       lambda w: w not in ({stops})) as w from cleaned),
        cells as (
            select doc_id, unnest(w) as term from words
            union all select doc_id, unnest(list_transform(range(1, len(w)),
                                            lambda i: w[i] || ' ' || w[i + 1])) from words)
        select term, count(*) as total, count(distinct doc_id) as docs,
               round(ln((1 + (select count(*) from cleaned)) / (1.0 + count(distinct doc_id)))
                     + 1, 6) as idf
        from cells group by term having count(distinct doc_id) >= 5
        order by total desc, term limit 100000"""


_BODIES["text_vocabulary"] = _vocabulary(STOP_WORDS)

_PER_STATE = """
    select state_code, state_name, count(*) as customers,
           round(avg(churn_probability), 6) as avg_probability, avg(churned) as churn_rate
    from fact_churn join dim_state using (state_sk) group by state_code, state_name"""
_COMPLAINTS = """
    select state_code, state_name, cast(sum(complaint_count) as bigint) as complaints
    from fact_comp join dim_state using (state_sk) group by state_code, state_name"""
_BODIES |= {
    "churn_per_state": _PER_STATE,
    "churn_per_state_top10": f"""
        select state_code, state_name, customers, avg_probability, churn_rate
        from (select *, row_number() over (order by customers desc, state_code) as r
              from ({_PER_STATE})) where r <= 10""",
    "complaints_per_state": _COMPLAINTS,
    "complaints_per_state_top10": _COMPLAINTS + " order by complaints desc, state_code limit 10",
}


def _integrity() -> str:
    tables = {"fact_churn_prediction": "fact_churn", "fact_complaints": "fact_comp"}
    parts = []

    def add(check, table, columns, counted):
        parts.append(f"select '{check}' as check_name, '{table}' as table_name, "
                     f"'{','.join(columns)}' as columns, ({counted}) as violations")

    def repeats(table, columns):
        return (f"select count(*) from (select 1 from {tables.get(table, table)} "
                f"group by {', '.join(columns)} having count(*) > 1)")

    keys = {"dim_state": ["state_sk"], "dim_date": ["date_sk"], "dim_customer": ["user_sk"],
            "dim_product": ["product_sk"], "fact_churn_prediction": ["user_sk", "date_sk"],
            "fact_complaints": ["state_sk", "product_sk", "date_sk"]}
    unique = {"dim_state": ["state_code"], "dim_date": ["full_date"],
              "dim_customer": ["user_id"], "dim_product": ["product_name"]}
    required = {
        "dim_state": ["state_sk", "state_code", "state_name"],
        "dim_date": ["date_sk", "full_date", "year", "month", "month_name"],
        "dim_customer": ["user_sk", "user_id"], "dim_product": ["product_sk", "product_name"],
        "fact_churn_prediction": ["user_sk", "state_sk", "date_sk", "churn_probability",
                                  "churned"],
        "fact_complaints": ["state_sk", "product_sk", "date_sk", "complaint_count"]}
    target = {"user_sk": "dim_customer", "state_sk": "dim_state", "date_sk": "dim_date",
              "product_sk": "dim_product"}
    for table, columns in keys.items():
        add("primary key", table, columns, repeats(table, columns))
    for table, columns in unique.items():
        add("unique", table, columns, repeats(table, columns))
    for table, columns in required.items():
        missing = " or ".join(f"{c} is null" for c in columns)
        add("not null", table, columns,
            f"select count(*) from {tables.get(table, table)} where {missing}")
    for table, column in sorted(_FOREIGN):
        add("foreign key", table, [column],
            f"select count(*) from {tables[table]} where {column} not in "
            f"(select {column} from {target[column]})")
    return " union all ".join(parts)


_BODIES["star_integrity"] = _integrity()

_LABELED = "(select l.*, h.state, h.gender, h.traffic_source from churn_labels l join home h on h.id = l.user_id)"
_SPLIT = (f"select l.*, p.split from {_LABELED} l join ("
          + _split(_LABELED, "user_id", "churned", {"train": 600, "validation": 800}, "test")
          + ") p on p.user_id = l.user_id")
_FEATURES = (
    f"select distinct 'gender=' || coalesce(gender, '(missing)') as feature from ({_SPLIT}) where split = 'train' "
    f"union select 'state=' || coalesce(state, '(missing)') from ({_SPLIT}) where split = 'train' "
    f"union select 'traffic_source=' || coalesce(traffic_source, '(missing)') from ({_SPLIT}) where split = 'train' "
    + " ".join(f"union select '{c}'" for c in _NUMBERS))
_STYLES = "(['plain', 'quoted', 'marked', 'swapped'])[complaint_id % 4 + 1]"
_BODIES |= {
    "complaint_headers": f"""
        select {_STYLES} as style, count(*) as records, {_STYLES} = 'swapped' as refused from complaints group by 1""",
    "refused_file": "select count(*) as complaints, 'swapped' as refused from complaints",
    "bronze_once": "select lang, count(*) as first_rows, count(*) as second_rows from documents group by lang",
    "word_keys": r"""
        select word, row_number() over (order by word) as word_sk
        from (select distinct unnest(regexp_extract_all(text, '[^ \t\n\r]+')) as word from documents)""",
    "stored_scores": f"select user_id, state, churned, split, true as in_range from ({_SPLIT})",
    "reloaded_model": f"select user_id, true as same from {_LABELED}",
    "training_supports": f"""
        select split, churned as actual, case split when 'validation' then 4 else 1 end as models,
               count(*) as least, count(*) as most
        from ({_SPLIT}) where split <> 'train' group by split, churned""",
    "importance_names": f"""
        select model, feature, true as in_range, true as whole
        from ({_FEATURES}), (values ('random_forest'), ('gradient_boosting')) m(model)""",
    "importance_ranks": f"select 15 as listed, count(*) as features, true as greatest from ({_FEATURES})",
    "topic_term_counts": "select distinct product, 8 as terms from cleaned",
    "topic_supports": "select product as name, count(*) as support from ("
    + _split("(select complaint_id, product from cleaned)", "complaint_id", "product", {"train": 800}, "test")
    + ") where split = 'test' group by product",
}


def _newton(rows: str, penalty: float) -> str:
    """``b0, b1, b2``: the weighted logistic fit of y on x1, x2 by Newton steps over counts of equal rows.

    The loss is summed with weights that balance the two classes, plus penalty / 2 * (b1^2 + b2^2).
    """
    step = "select step, b0, b1, b2, y, x1, x2, w, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) as p from fit, cells"
    minor = {
        "d": "h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02)",
        "d0": "g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)",
        "d1": "h00 * (g1 * h22 - g2 * h12) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)",
        "d2": "h00 * (h11 * g2 - h12 * g1) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)",
    }
    return f"""
        with recursive counted as (select y, x1, x2, count(*) as n from ({rows}) group by y, x1, x2),
        cells as (
            select cast(y as double) as y, cast(x1 as double) as x1, cast(x2 as double) as x2,
                   n * (sum(n) over ()) / (2.0 * sum(n) over (partition by y)) as w from counted),
        fit as (
            select 0 as step, 0.0::double as b0, 0.0::double as b1, 0.0::double as b2
            union all
            select step + 1, b0 - ({minor["d0"]}) / ({minor["d"]}), b1 - ({minor["d1"]}) / ({minor["d"]}),
                   b2 - ({minor["d2"]}) / ({minor["d"]})
            from (select step, b0, b1, b2, sum(w * (p - y)) as g0,
                         sum(w * (p - y) * x1) + {penalty} * b1 as g1, sum(w * (p - y) * x2) + {penalty} * b2 as g2,
                         sum(w * p * (1 - p)) as h00, sum(w * p * (1 - p) * x1) as h01, sum(w * p * (1 - p) * x2) as h02,
                         sum(w * p * (1 - p) * x1 * x1) + {penalty} as h11, sum(w * p * (1 - p) * x1 * x2) as h12,
                         sum(w * p * (1 - p) * x2 * x2) + {penalty} as h22
                  from ({step}) where step < 25 group by step, b0, b1, b2))
        select b0, b1, b2 from fit where step = 25"""


# two classes share a multinomial penalty: each has half of the coefficients, with opposite signs
_TERMS = _newton("""select (lang = 'en')::int as y, contains(text, ' the ')::int as x1, contains(text, ' and ')::int as x2
                    from documents where lang is not null and text is not null""", 0.5)
_BODIES |= {
    "forest_depths": "select unnest([2, 5, 10]) as depth, true as grown, true as in_range",
    "churn_regression_fit": f"""
        select unnest(['intercept', 'order_count']) as term, unnest([round(b0, 3), round(b1, 3)]) as coefficient
        from ({_newton("select churned as y, order_count as x1, 0 as x2 from dataset", 1.0)})""",
    "topic_regression_fit": f"""
        select label, round(side * b0, 3) as intercept, round(side * b1, 3) as the, round(side * b2, 3) as "and"
        from ({_TERMS}), (values (0, -0.5), (1, 0.5)) sides(label, side)""",
}


def oracles() -> dict[str, str]:
    return {name: _merge(with_steps(body), body) for name, body in _BODIES.items()}


def _merge(full: str, body: str) -> str:
    """A body with its own WITH continues the list of steps."""
    own = body.lstrip()
    if full == body or not own.startswith("with "):
        return full
    return full[: -len(body) - 1] + ", " + own[len("with "):]
