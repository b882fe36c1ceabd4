"""Independent SQL for the named queries, written for a single-node engine over the same tables."""

from __future__ import annotations

TX = """tx as (
select event_id as trans_num, user_id as cc_num, ts as trans_ts, value as amt, event_type as category,
       concat('m_', (event_id * 7 + user_id) % 41) as merchant,
       case when user_id % 2 = 0 then 'F' else 'M' end as gender,
       cast(500 + (user_id * 7919) % 90000 as int) as city_pop,
       case when user_id % 29 = 0 then null
            else date '1940-01-01' + cast((user_id * 104729) % 22000 as int) end as dob,
       25e0 + cast((event_id * 7919) % 2400 as double) / 1e2 as merch_lat,
       -120e0 + cast((event_id * 104729) % 5000 as double) / 1e2 as merch_long,
       case when (event_id * 31 + user_id) % 53 = 0 or (value > 150 and event_id % 7 = 0) then 1 else 0 end as is_fraud
from events)"""

SCORES = TX + """, s as (
select trans_num as id, is_fraud as y, amt, category, trans_ts,
       cast(floor(least(amt, 4e2) / 4e0) as double) / 1e2 as p_tied, amt / 5e2 as p from tx)"""

RANKED = TX + """, total as (select count(*) as n from tx), ranked as (
select tx.*, row_number() over (order by trans_ts, trans_num) as rn, n from tx, total)"""

TRAIN = RANKED + """, train as (select * from ranked where rn <= floor(n * 8e-1)),
test as (select * from ranked where rn > floor(n * 8e-1))"""

FOLDS = RANKED + """, folds as (
select *, case when rn <= floor(floor(n * 8e-1) * (1e0 - 15e-2)) then 'fit'
               when rn <= floor(n * 8e-1) then 'val' else 'test' end as fold from ranked)"""


def _round(inner: str, doubles: str, others: str = "", digits: int = 6, ctes: str = "") -> str:
    cols = [c.strip() for c in others.split(",") if c.strip()]
    cols += [f"round({c.strip()} + 1.2345678e-{digits + 2}, {digits}) + 0e0 as {c.strip()}" for c in doubles.split(",") if c.strip()]
    return f"{'with ' + ctes if ctes else ''} select {', '.join(cols)} from ({inner}) q"


def _history(source: str, windows: dict[str, str], extra: str = "") -> str:
    """Features of `source` rows by plain window frames."""
    frames = ",\n".join(
        f"cast(count(amt) over {w} as double) as txn_count_{w}, coalesce(sum(amt) over {w}, 0e0) as txn_amount_{w}"
        for w in windows)
    defs = ",\n".join(
        f"\"{w}\" as (partition by cc_num order by trans_ts range between interval {iv} preceding and interval 1 microsecond preceding)"
        for w, iv in windows.items())
    frames = frames.replace("over 1h", 'over "1h"').replace("over 24h", 'over "24h"').replace("over 30d", 'over "30d"').replace("over 90d", 'over "90d"')
    return f"""
select h.*, coalesce((amt - amt_hist_mean) / nullif(amt_hist_std, 0e0), 0e0) as amt_zscore,
  coalesce(2 * 6371.0088e0 * asin(sqrt(least(1e0, greatest(0e0, pow(sin(radians(merch_lat - lat0) / 2), 2)
     + cos(radians(lat0)) * cos(radians(merch_lat)) * pow(sin(radians(merch_long - lon0) / 2), 2))))), 0e0) as dist_from_prev_km,
  coalesce((epoch_us(trans_ts) - epoch_us(ts0)) / 36e8, 0e0) as time_since_prev_h
from (select *{extra}, {frames},
  coalesce(avg(amt) over prior, amt) as amt_hist_mean, coalesce(stddev_samp(amt) over prior, 0e0) as amt_hist_std,
  lag(merch_lat) over seq as lat0, lag(merch_long) over seq as lon0, lag(trans_ts) over seq as ts0
  from {source}
  window {defs},
  prior as (partition by cc_num order by trans_ts, trans_num rows between unbounded preceding and 1 preceding),
  seq as (partition by cc_num order by trans_ts, trans_num)) h"""


_STD = {"1h": "1 hour", "24h": "24 hours"}
_SPEED = "case when time_since_prev_h > 0 then dist_from_prev_km / greatest(time_since_prev_h, 1e0 / 6e1) else 0e0 end as speed_kmh"
_ENC = """
, n_train as (select count(*) as n, avg(is_fraud) as prior from train),
merchant_enc as (select merchant, count(*) / max(n_train.n) as merchant_freq,
   (sum(is_fraud) + 50 * max(prior)) / (count(*) + 50) as merchant_target_enc from train, n_train group by merchant),
category_enc as (select category, count(*) / max(n_train.n) as category_freq,
   (sum(is_fraud) + 50 * max(prior)) / (count(*) + 50) as category_target_enc from train, n_train group by category)"""
_ENC_COLS = """coalesce(merchant_freq, 0e0) as merchant_freq, coalesce(category_freq, 0e0) as category_freq,
   coalesce(category_target_enc, prior) as category_target_enc, coalesce(merchant_target_enc, prior) as merchant_target_enc"""
_FEATURES = ("txn_count_1h, txn_amount_1h, txn_count_24h, txn_amount_24h, amt_hist_mean, amt_hist_std, amt_zscore, "
             "dist_from_prev_km, time_since_prev_h, speed_kmh, merchant_freq, category_freq, category_target_enc, "
             "merchant_target_enc, age, amt")


def _engineered(source: str, where: str = "true") -> str:
    age = "date_diff('day', dob, cast(trans_ts as date))"
    inner = f"""
select f.*, {_SPEED}, {_ENC_COLS}, cast(hour(trans_ts) as int) as hour, cast(isodow(trans_ts) - 1 as int) as day_of_week,
  case when hour(trans_ts) <= 5 then 1 else 0 end as is_night,
  coalesce(round({age} / 365.25e0, 1), (select quantile_cont({age}, 0.5) / 365.25e0 from {source})) as age
from ({_history(source, _STD)}) f left join merchant_enc using (merchant) left join category_enc using (category), n_train
where {where}"""
    return _round(inner, _FEATURES, "trans_num, hour, day_of_week, is_night, city_pop, gender, is_fraud", ctes=TRAIN + _ENC)


def _steps(score: str) -> str:
    return f""", g as (select {score} as score, sum(y) as pos, count(*) - sum(y) as neg from s group by 1), steps as (
select *, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp,
  sum(pos) over () as all_pos, sum(neg) over () as all_neg from g)"""


_AP = "sum(pos * tp / (tp + fp)) / sum(pos)"
_AUC = "sum(neg * (tp - pos + pos / 2e0)) / (sum(pos) * sum(neg))"


def _conf(t: float) -> str:
    return f"""select count(*) filter (p >= {t}e0 and y = 1) as tp, count(*) filter (p >= {t}e0 and y = 0) as fp,
  count(*) filter (p < {t}e0 and y = 1) as fn, count(*) filter (p < {t}e0 and y = 0) as tn from s"""


_RATES = """coalesce(tp / nullif(tp + fp, 0), 0e0) as "precision", coalesce(tp / nullif(tp + fn, 0), 0e0) as recall"""
_F1 = "coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0e0) as f1"


def _hist(source: str, bins: int, by: str = "", density: bool = False) -> str:
    key = f"{by}, " if by else ""
    on = f"using ({by})" if by else "on true"
    group = f"group by {by}" if by else ""
    join_n = f"left join counts using ({key} bin)"
    return f"""spans as (select {key} min(amt) as lo, max(amt) as hi, count(*) as total from {source} {group}),
counts as (select {key} cast(least(floor((amt - lo) * {bins}e0 / (hi - lo)), {bins - 1}) as int) as bin, count(*) as n
  from {source} join spans {on} group by all),
filled as (select {key} cast(bin as int) as bin, lo + bin * ((hi - lo) / {bins}e0) as left_edge, total, (hi - lo) / {bins}e0 as width
  from spans, range({bins}) r(bin)),
h as (select {key} bin, left_edge, cast(coalesce(n, 0) as bigint) as n{', coalesce(n, 0) / (total * width) as density' if density else ''}
  from filled {join_n})"""


_GRID = """, grid as (select distinct threshold from (select unnest(quantile_cont(p, [i / 199e0 for i in range(200)])) as threshold from s))"""


def _sweep(costs: tuple[float, float, float, float], amount: bool) -> str:
    c_fn, c_fp, c_tp, c_tn = costs
    lost = "coalesce(sum(amt) filter (p < threshold and y = 1), 0)" if amount else "count(*) filter (p < threshold and y = 1)"
    return f""", raw as (select threshold, count(*) filter (p >= threshold and y = 1) as tp, count(*) filter (p >= threshold and y = 0) as fp,
  count(*) filter (p < threshold and y = 1) as fn, count(*) filter (p < threshold and y = 0) as tn, {lost} as lost
  from grid, s group by threshold),
sweep as (select threshold, {c_fn}e0 * lost + {c_fp}e0 * fp + {c_tp}e0 * tp + {c_tn}e0 * tn as total_cost, {_RATES}, tp, fp, fn, tn from raw)"""


_PR = """, pts as (select score as threshold, tp / (tp + fp) as "precision", tp / all_pos as recall from steps)"""

# Online rules: whole seconds, both window ends closed, only a card's last 100 earlier rows.
_ONLINE = TX + """, o as (select *, cast(floor(epoch_us(trans_ts) / 1e6) as bigint) as clock_s from tx),
k as (select *, row_number() over (partition by cc_num order by clock_s, trans_num) as rn from o),
v as (select a.trans_num, count(b.rn) filter (a.clock_s - b.clock_s <= 3600) as txn_count_1h, count(b.rn) filter (a.clock_s - b.clock_s <= 86400) as txn_count_24h,
   coalesce(sum(b.amt) filter (a.clock_s - b.clock_s <= 3600), 0e0) as txn_amount_1h, coalesce(sum(b.amt) filter (a.clock_s - b.clock_s <= 86400), 0e0) as txn_amount_24h
   from k a left join k b on a.cc_num = b.cc_num and b.rn between a.rn - 100 and a.rn - 1 group by a.trans_num),
g as (select a.trans_num, a.amt, b.rn is null as cold, (a.clock_s - b.clock_s) / 36e2 as gap, 2 * 6371.0088e0 * asin(sqrt(pow(sin(radians(a.merch_lat - b.merch_lat) / 2), 2)
   + cos(radians(b.merch_lat)) * cos(radians(a.merch_lat)) * pow(sin(radians(a.merch_long - b.merch_long) / 2), 2))) as km
   from k a left join k b on a.cc_num = b.cc_num and b.rn = a.rn - 1),
online as (select trans_num, txn_count_1h, txn_count_24h, txn_amount_1h, txn_amount_24h, coalesce(km, 0e0) as dist_from_prev_km,
   case when cold then 999e0 else gap end as time_since_prev_h, case when cold then 0e0 else km / greatest(gap, 1e0 / 6e1) end as speed_kmh,
   cast(cold as int) as cold_start from v join g using (trans_num))"""
_ONLINE_DOUBLES = "txn_amount_1h, txn_amount_24h, dist_from_prev_km, time_since_prev_h, speed_kmh"

_D2 = """(a.amt - b.amt) * (a.amt - b.amt) + (a.merch_lat - b.merch_lat) * (a.merch_lat - b.merch_lat)
  + (a.merch_long - b.merch_long) * (a.merch_long - b.merch_long) + cast(a.city_pop - b.city_pop as double) * cast(a.city_pop - b.city_pop as double)"""
_NEAR = TX + f""", f as (select * from tx where is_fraud = 1),
near as (select a.trans_num, b.trans_num as neighbour, b.amt as n_amt, b.merch_lat as n_lat, b.merch_long as n_long, b.city_pop as n_pop,
   row_number() over (partition by a.trans_num order by {_D2}, b.trans_num) as place
   from f a join f b on a.trans_num <> b.trans_num qualify place <= 5)"""
_LINKS = TX + f""", out as (select a.trans_num as x, arg_min(b.trans_num, ({_D2}, b.trans_num)) as nn from tx a join tx b on a.trans_num <> b.trans_num
   where a.is_fraud = 1 group by 1),
back as (select a.trans_num as x, arg_min(b.trans_num, ({_D2}, b.trans_num)) as nn from tx a join tx b on a.trans_num <> b.trans_num
   where a.trans_num in (select nn from out) group by 1),
links as (select least(out.x, out.nn) as low_id, greatest(out.x, out.nn) as high_id from out join back on out.nn = back.x and back.nn = out.x
   join tx on tx.trans_num = out.nn where tx.is_fraud = 0)"""


def _hash(text: str) -> str:
    """The number in [0, 1) that the first 8 hex digits of an md5 stand for."""
    return f"cast(cast('0x' || substr(md5({text}), 1, 8) as ubigint) as double) / 4294967296e0"


_SMOTE = _NEAR + f""", size as (select count(*) filter (is_fraud = 1) as pos, cast(floor(1e-1 * count(*) filter (is_fraud = 0)) as bigint) - count(*) filter (is_fraud = 1) as need from tx),
lots as (select f.*, need // pos + case when row_number() over (order by {_hash("concat(trans_num, ':extra:42')")}, trans_num) <= need % pos then 1 else 0 end as times from f, size),
copies as (select lots.*, unnest(range(1, times + 1)) as copy from lots),
held as (select trans_num, count(*) as held from near group by 1),
picked as (select c.*, {_hash("concat(c.trans_num, ':', c.copy, ':u:42')")} as u,
   1 + floor({_hash("concat(c.trans_num, ':', c.copy, ':n:42')")} * held) as place from copies c join held using (trans_num))"""



def _newton(steps: int) -> str:
    """Unrolled Newton steps of the two-parameter logistic fit on smoothed targets."""
    out = """, n as (select sum(y) as n1, count(*) - sum(y) as n0 from s),
t as (select p_tied as x, count(*) as w, sum(y) * max((n1 + 1e0) / (n1 + 2e0)) + (count(*) - sum(y)) * max(1e0 / (n0 + 2e0)) as soft from s, n group by 1),
w0 as (select 0e0 as a, 0e0 as b)"""
    for i in range(steps):
        out += f""", m{i} as (select max(a) as a, max(b) as b, sum(w * q * (1 - q) * x * x) as xx, sum(w * q * (1 - q) * x) as x1, sum(w * q * (1 - q)) as one,
  sum((soft - w * q) * x) as gx, sum(soft - w * q) as g1 from (select *, 1e0 / (1e0 + exp(-(a * x + b))) as q from t, w{i})),
w{i + 1} as (select a + (one * gx - x1 * g1) / (xx * one - x1 * x1) as a, b + (xx * g1 - x1 * gx) / (xx * one - x1 * x1) as b from m{i})"""
    return out


ORACLES: dict[str, str] = {
    "platt_calibration": _round("select id, 1e0 / (1e0 + exp(-(a * p_tied + b))) as p_cal from s, w12", "p_cal", "id", 4, SCORES + _newton(12)),
    "online_features_replay": _round("select * from online", _ONLINE_DOUBLES, "trans_num, txn_count_1h, txn_count_24h, cold_start", 2, _ONLINE),
    "stream_online_features": _round("select * from online", _ONLINE_DOUBLES, "trans_num, txn_count_1h, txn_count_24h, cold_start", 2, _ONLINE),
    "online_overwrite": _round(f"""select cast(txn_count_1h as double) as txn_count_1h, cast(txn_count_24h as double) as txn_count_24h, amt_hist_mean, o.* exclude (txn_count_1h, txn_count_24h)
          from online o join (select trans_num, coalesce(avg(amt) over (partition by cc_num order by trans_ts, trans_num rows between unbounded preceding and 1 preceding), amt) as amt_hist_mean from tx) using (trans_num)""",
        _ONLINE_DOUBLES + ", txn_count_1h, txn_count_24h, amt_hist_mean", "trans_num", 2, _ONLINE),
    "minority_neighbours": f"with {_NEAR} select trans_num, cast(place as int) as place, neighbour from near",
    "smote": _round("""select p.trans_num, p.copy, p.is_fraud, p.amt + u * (n_amt - p.amt) as amt, merch_lat + u * (n_lat - merch_lat) as merch_lat,
          merch_long + u * (n_long - merch_long) as merch_long, city_pop + u * (n_pop - city_pop) as city_pop from picked p join near using (trans_num, place)""",
        "amt, merch_lat, merch_long, city_pop", "trans_num, is_fraud, cast(copy as int) as copy", ctes=_SMOTE),
    "tomek_links": f"with {_LINKS} select low_id, high_id from links",
    "without_tomek_links": f"with {_LINKS} select trans_num, is_fraud from tx where trans_num not in (select low_id from links) and trans_num not in (select high_id from links)",

    "time_features": f"""with {TX} select trans_num, cast(hour(trans_ts) as int) as hour, cast(isodow(trans_ts) - 1 as int) as day_of_week,
        case when hour(trans_ts) <= 5 then 1 else 0 end as is_night from tx""",
    "card_velocity": _round(_history("tx", _STD), "txn_count_1h, txn_amount_1h, txn_count_24h, txn_amount_24h", "trans_num", ctes=TX),
    "amount_behaviour": _round(_history("tx", _STD), "amt_hist_mean, amt_hist_std, amt_zscore", "trans_num", ctes=TX),
    "geo_travel": _round(f"select *, {_SPEED} from ({_history('tx', _STD)})", "dist_from_prev_km, time_since_prev_h, speed_kmh",
                         "trans_num", ctes=TX),
    "tied_history": _round(_history("o", {"30d": "30 days", "90d": "90 days"}),
        "txn_count_30d, txn_amount_30d, txn_count_90d, txn_amount_90d, amt_hist_mean, amt_hist_std, time_since_prev_h", "trans_num", 4,
        "o as (select o_orderkey as trans_num, o_custkey as cc_num, o_orderdate as trans_ts, o_totalprice as amt, 0e0 as merch_lat, 0e0 as merch_long from orders)"),
    "customer_age": f"""with {TX}, a as (select trans_num, date_diff('day', dob, cast(trans_ts as date)) / 365.25e0 as years from tx)
        select trans_num, round(coalesce(round(years, 1), (select quantile_cont(years, 0.5) from a)) + 1.2345678e-8, 6) as age from a""",
    "frequency_encoding": _round(f"select trans_num, {_ENC_COLS} from tx left join merchant_enc using (merchant) left join category_enc using (category), n_train",
        "merchant_freq, category_freq", "trans_num", ctes=TRAIN + _ENC),
    "target_encoding": _round(f"select trans_num, {_ENC_COLS} from tx left join merchant_enc using (merchant) left join category_enc using (category), n_train",
        "category_target_enc, merchant_target_enc", "trans_num", ctes=TRAIN + _ENC),
    "encoder_tables": _round("select category, count(*) / (select count(*) from tx) as category_freq, (sum(is_fraud) + 50 * (select avg(is_fraud) from tx)) / (count(*) + 50) as category_target_enc from tx group by category",
        "category_freq, category_target_enc", "category", ctes=TX),
    "engineered_features": _engineered("tx"),
    "history_transform": _engineered("tx", "trans_num in (select trans_num from test)"),
    "feature_gaps": "select " + ", ".join(f"cast(0 as bigint) as {c.strip()}" for c in (
        "trans_num, hour, day_of_week, is_night, city_pop, gender, is_fraud, " + _FEATURES).split(",")) + " from (select count(*) from events)",
    "defaults_without_profile": f"""with {TX}, m as (select merchant, count(*) / (select count(*) from tx) as f from tx group by 1)
        select trans_num, cast(0 as bigint) as city_pop, 'U' as gender, round(f + 1.2345678e-8, 6) as merchant_freq, cast(22 as int) as columns_n from tx join m using (merchant)""",
    "categories": f"""with {TX}, v as (select category, cast(row_number() over (order by category) - 1 as int) as code
          from (select distinct category from tx where amt > 20 and category <> 'error'))
        select trans_num, v.category, coalesce(code, -1) as category_code from tx left join v using (category)""",
    "raw_csv_stack": _round("""select trans_num, cc_num, cast(floor(epoch_us(trans_ts) / 1e6) as bigint) as clock_s, amt, category, gender, city_pop, is_fraud,
        case when dob is null then 1 else 0 end as dob_missing from tx""", "amt", "trans_num, cc_num, clock_s, category, gender, city_pop, is_fraud, dob_missing", ctes=TX),
    "event_clock": f"""with {TX} select trans_num, cast(floor(epoch_us(trans_ts) / 1e6) as bigint) - case when trans_num % 3 = 0 then 0 else 86400 end as clock_s,
        case when trans_num % 5 = 0 or dob is null then 1 else 0 end as dob_missing from tx""",
    "travel_from_home": f"""with {TX} select trans_num, round(2 * 6371.0088e0 * asin(sqrt(pow(sin(radians(40e0 - merch_lat) / 2), 2)
        + cos(radians(merch_lat)) * cos(radians(40e0)) * pow(sin(radians(-100e0 - merch_long) / 2), 2))) + 1.2345678e-8, 6) as km from tx""",
    "decisions": f"""with {SCORES} select id, round_even(p, 4) as p4, case when p >= 1e-1 then 'fraud' else 'not_fraud' end as decision from s""",
    "chrono_split": f"with {TRAIN} select trans_num, 'train' as fold from train union all select trans_num, 'test' from test",
    "chrono_folds": f"with {FOLDS} select trans_num, fold from folds",
    "tied_split": """with r as (select o_orderkey as trans_num, row_number() over (order by o_orderdate, o_orderkey) as rn, count(*) over () as n from orders)
        select trans_num, case when rn <= floor(n * 7e-1) then 'train' else 'test' end as fold from r""",
    "recent_subsample": f"""with {TRAIN}, a as (select trans_num, 'train' as part, row_number() over (order by rn desc) as back, count(*) over () as m from train
        union all select trans_num, 'test', row_number() over (order by rn desc), count(*) over () from test)
        select trans_num, part from a where back <= floor(m * 1e-1)""",
    "tuning_tail": f"with {TRAIN} select trans_num from train where rn > floor((select count(*) from train) * (1e0 - 3e-1))",
    "fold_bounds": f"with {FOLDS} select fold, epoch_us(min(trans_ts)) as first_us, epoch_us(max(trans_ts)) as last_us from folds group by fold",
    "fit_plus_val": f"with {TRAIN} select trans_num, is_fraud from train",
    "seeded_sample": f"with {TX} select trans_num from tx order by md5(concat(trans_num, ':42')), trans_num limit 4000",
    "highest_scored_positive": f"with {SCORES} select id, round(p + 1.2345678e-8, 6) as p from s where y = 1 order by p desc, id limit 1",
    "split_summary": _round("""select fold, count(*) as rows_n, 12 as columns_n, cast(floor(epoch_us(min(trans_ts)) / 1e6) as bigint) as first_s,
        cast(floor(epoch_us(max(trans_ts)) / 1e6) as bigint) as last_s, count(*) filter (is_fraud = 1) as positives,
        count(*) filter (is_fraud = 0) as negatives, avg(is_fraud) * 1e2 as rate_pct from folds group by fold""",
        "rate_pct", "fold, rows_n, columns_n, first_s, last_s, positives, negatives", ctes=FOLDS),
    "missing_audit": "with " + TX + " " + " union all ".join(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as missing, round(count(*) filter ({c} is null) * 1e2 / count(*), 2) as missing_pct from tx"
        for c in ("trans_num", "cc_num", "trans_ts", "amt", "category", "merchant", "gender", "city_pop", "dob", "merch_lat", "merch_long", "is_fraud")),
    "class_balance": _round("""select fold, count(*) as rows_n, cast(sum(is_fraud) as bigint) as positives, cast(count(*) - sum(is_fraud) as bigint) as negatives,
          avg(is_fraud) * 1e2 as rate_pct from (select fold, is_fraud from folds union all select 'all', is_fraud from folds) group by fold""",
        "rate_pct", "fold, rows_n, positives, negatives", ctes=FOLDS),
    "class_ratio": _round("select count(*) filter (is_fraud = 0) / greatest(count(*) filter (is_fraud = 1), 1) as class_ratio from folds where fold = 'fit'",
        "class_ratio", ctes=FOLDS),
    "amount_describe": _round("""select count(amt) as n, avg(amt) as mean, stddev_samp(amt) as std, min(amt) as min, max(amt) as max,
        quantile_cont(amt, 0.25) as q25, quantile_cont(amt, 0.5) as q50, quantile_cont(amt, 0.75) as q75 from tx""",
        "mean, std, min, max, q25, q50, q75", "n", ctes=TX),
    "order_value_describe": _round("""select count(*) as n, avg(l_extendedprice) as mean, stddev_samp(l_extendedprice) as std, min(l_extendedprice) as min,
        max(l_extendedprice) as max, quantile_cont(l_extendedprice, 0.25) as q25, quantile_cont(l_extendedprice, 0.5) as q50,
        quantile_cont(l_extendedprice, 0.75) as q75 from lineitem""", "mean, std, min, max, q25, q50, q75", "n", 3),
    "amount_by_class": _round("select is_fraud, count(amt) as n, avg(amt) as mean, stddev_samp(amt) as std, min(amt) as min, max(amt) as max, median(amt) as median from tx group by is_fraud",
        "mean, std, min, max, median", "is_fraud, n", ctes=TX),
    "rate_by_hour": _round("select cast(hour(trans_ts) as int) as hour, avg(is_fraud) * 1e2 as rate_pct, count(*) as n from tx group by 1", "rate_pct", "hour, n", ctes=TX),
    "top_hours": _round("select cast(hour(trans_ts) as int) as hour, avg(is_fraud) * 1e2 as rate_pct, count(*) as n from tx group by 1 order by 2 desc, 1 limit 5",
        "rate_pct", "hour, n", ctes=TX),
    "rate_by_category": _round("select category, avg(is_fraud) * 1e2 as rate_pct, count(*) as n from tx group by 1", "rate_pct", "category, n", ctes=TX),
    "rate_by_merchant": _round("select merchant, avg(is_fraud) * 1e2 as rate_pct, count(*) as n from tx group by 1 having count(*) >= 100 order by 2 desc, 1 limit 20",
        "rate_pct", "merchant, n", ctes=TX),
    "distinct_merchants": f"with {TX} select count(distinct merchant) as distinct_n from tx",
    "time_range": f"""with {TX}, b as (select cast(floor(epoch_us(min(trans_ts)) / 1e6) as bigint) as first_s, cast(floor(epoch_us(max(trans_ts)) / 1e6) as bigint) as last_s from tx)
        select first_s, last_s, (last_s - first_s) // 86400 as span_days from b""",
    "amount_histogram": _round("select * from h", "left_edge", "bin, n", ctes=TX + ", " + _hist("tx", 100)),
    "small_amount_histogram": _round("select * from h", "left_edge", "bin, n",
        ctes=TX + ", small as (select * from tx where amt < 500), " + _hist("small", 100)),
    "class_histogram": _round("select * from h", "left_edge", "is_fraud, bin, n", ctes=TX + ", " + _hist("tx", 80, "is_fraud")),
    "clipped_histogram": _round("select * from h", "left_edge, density", "is_fraud, bin, n", ctes=TX + """, cl as (select is_fraud,
        least(greatest(amt, (select quantile_cont(amt, 0.01) from tx)), (select quantile_cont(amt, 0.99) from tx)) as amt from tx), """
        + _hist("cl", 40, "is_fraud", True)),
    "quantile_grid": """select cast(i as int) as step, round(v + 1.2345678e-8, 6) as value from (select unnest(range(21)) as i,
        unnest(quantile_cont(l_extendedprice, [i / 20e0 for i in range(21)])) as v from lineitem)""",
    "latency_summary": _round("""select max(rn) as n, max(value) as max_ms, avg(value) as mean_ms,
          max(rn) / ((max(epoch_us(ts) + cast(round(value * 1000) as bigint)) - min(epoch_us(ts))) / 1e6) as per_second,
          max(value) filter (rn = round_even(0.5e0 * n + 0.5e0, 0)) as p50, max(value) filter (rn = round_even(0.95e0 * n + 0.5e0, 0)) as p95,
          max(value) filter (rn = round_even(0.99e0 * n + 0.5e0, 0)) as p99
        from (select value, ts, row_number() over (order by value) as rn, count(*) over () as n from events)""",
        "max_ms, mean_ms, per_second, p50, p95, p99", "n"),
    "confusion": f"with {SCORES} {_conf(0.2)}",
    "point_metrics": _round(f"select *, {_RATES}, {_F1} from ({_conf(0.2)})", '"precision", recall, f1', "tp, fp, fn, tn", ctes=SCORES),
    "average_precision": f"""with {SCORES} {_steps('p')}, {_steps('p_tied')[2:].replace('g as', 'g2 as').replace('from g)', 'from g2)').replace('steps as', 'steps2 as')}
        select round((select {_AP} from steps) + 1.2345678e-8, 6) as average_precision, round((select {_AP} from steps2) + 1.2345678e-8, 6) as average_precision_tied""",
    "base_rate": f"with {SCORES} select round(avg(y) + 1.2345678e-8, 6) as base_rate from s",
    "roc_auc": f"""with {SCORES} {_steps('p')}, {_steps('p_tied')[2:].replace('g as', 'g2 as').replace('from g)', 'from g2)').replace('steps as', 'steps2 as')}
        select round((select {_AUC} from steps) + 1.2345678e-8, 6) as roc_auc, round((select {_AUC} from steps2) + 1.2345678e-8, 6) as roc_auc_tied""",
    "pr_curve": _round("select * from pts union all select null, 1e0, 0e0", 'threshold, "precision", recall', ctes=SCORES + _steps("p") + _PR),
    "roc_curve": _round("select score as threshold, fp / all_neg as fpr, tp / all_pos as tpr from steps union all select null, 0e0, 0e0",
        "threshold, fpr, tpr", ctes=SCORES + _steps("p_tied")),
    "recall_at_precision": _round("select max(recall) as recall_at_precision from (select * from pts union all select null, 1e0, 0e0) where \"precision\" >= 15e-2",
        "recall_at_precision", ctes=SCORES + _steps("p") + _PR),
    "threshold_at_precision": _round("select coalesce(min(threshold) filter (\"precision\" >= 15e-2), 1e0) as threshold from pts", "threshold",
        ctes=SCORES + _steps("p") + _PR),
    "metric_bundle": _round(f"""select *, {_RATES}, {_F1} from (select {_AP} as pr_auc, {_AUC} as roc_auc,
          coalesce(max(tp) filter (tp / (tp + fp) >= 15e-2), 0) / sum(pos) as recall_at_p15 from steps),
          ({_conf(0.3).replace('p >=', 'p_tied >=').replace('p <', 'p_tied <')})""",
        'pr_auc, roc_auc, "precision", recall, f1, recall_at_p15', ctes=SCORES + _steps("p_tied")),
    "classification_report": f"""with {SCORES}, c as ({_conf(0.3)}), k as (
          select '0' as row_name, coalesce(tn / nullif(tn + fn, 0), 0e0) as p, coalesce(tn / nullif(tn + fp, 0), 0e0) as r,
             coalesce(2e0 * tn / nullif(2 * tn + fp + fn, 0), 0e0) as f, tn + fp as support from c
          union all select '1', coalesce(tp / nullif(tp + fp, 0), 0e0), coalesce(tp / nullif(tp + fn, 0), 0e0),
             coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0e0), tp + fn from c),
        a as (select * from k union all select 'macro avg', avg(p), avg(r), avg(f), sum(support) from k
          union all select 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), sum(f * support) / sum(support), sum(support) from k
          union all select 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn from c)
        select row_name, round(p, 4) as "precision", round(r, 4) as recall, round(f, 4) as f1, cast(support as bigint) as support from a""",
    "flat_cost": f"""with {SCORES}, c as ({_conf(0.2)}) select fn as flat_fn, fp as flat_fp, 1e2 * fn + 5e0 * fp as flat_total_cost,
        round((1e2 * fn + 5e0 * fp) / (tp + fp + fn + tn) + 1.2345678e-8, 6) as flat_cost_per_txn from c""",
    "amount_cost": _round(f"""select *, 2e-1 as threshold, lost + 5e0 * fp as total_cost, (lost + 5e0 * fp) / (tp + fp + fn + tn) as cost_per_txn, {_RATES}
          from ({_conf(0.2)}), (select sum(amt) filter (p < 2e-1 and y = 1) as lost from s)""",
        'threshold, total_cost, cost_per_txn, "precision", recall', "tp, fp, fn, tn", ctes=SCORES),
    "threshold_sweep": _round("select * from sweep", 'threshold, total_cost, "precision", recall', "tp, fp, fn, tn",
        ctes=SCORES + _GRID + _sweep((1, 5, 2, 0.01), True)),
    "threshold_sweep_exact": _round("select * from sweep", 'threshold, total_cost, "precision", recall', "tp, fp, fn, tn",
        ctes=SCORES.replace("s as (", "s0 as (") + """, s as (select id, y, amt, p_tied as p from s0), grid as (select distinct p as threshold from s)"""
        + _sweep((100, 5, 0, 0), False)),
    "best_threshold": _round("select *, total_cost / (select count(*) from s) as cost_per_txn from sweep order by total_cost, threshold limit 1",
        'threshold, total_cost, cost_per_txn, "precision", recall', "tp, fp, fn, tn", ctes=SCORES + _GRID + _sweep((1, 5, 0, 0), True)),
    "f1_threshold": _round("""select f.threshold as f1_threshold, (select coalesce(sum(amt) filter (p < f.threshold and y = 1), 0) + 5e0 * count(*) filter (p >= f.threshold and y = 0) from s) as f1_cost,
          best_f1, b.threshold as cost_threshold, b.total_cost as best_cost,
          (select coalesce(sum(amt) filter (p < f.threshold and y = 1), 0) + 5e0 * count(*) filter (p >= f.threshold and y = 0) from s) - b.total_cost as saving
        from (select threshold, 2 * "precision" * recall / ("precision" + recall) as best_f1 from pts where recall > 0 order by 2 desc, 1 limit 1) f,
          (select * from sweep order by total_cost, threshold limit 1) b""",
        "f1_threshold, f1_cost, best_f1, cost_threshold, best_cost, saving", ctes=SCORES + _steps("p") + _PR + _GRID + _sweep((1, 5, 0, 0), True)),
    "brier_log_loss": _round("""select avg((p_tied - y) * (p_tied - y)) as brier,
          avg(-ln(case when y = 1 then q else 1e0 - q end)) as log_loss
        from (select *, least(greatest(p_tied, 2.220446049250313e-16), 1e0 - 2.220446049250313e-16) as q from s)""", "brier, log_loss", ctes=SCORES),
    "reliability_curve": _round("""select bin, avg(p) as mean_score, avg(y) as positive_share, count(*) as n from (
          select p, y, cast((select count(*) from unnest(e) t(x) where x < p) as int) as bin
          from s, (select quantile_cont(p, [i / 10e0 for i in range(1, 10)]) as e from s)) group by bin""",
        "mean_score, positive_share", "bin, n", ctes=SCORES),
    # Least upper value of averages over blocks of consecutive scores.
    "isotonic_calibration": f"""with {SCORES}, g as (select p_tied, row_number() over (order by p_tied) as i, count(*) as w, sum(y) as pos from s group by p_tied),
        c as (select i, sum(w) over (order by i) as cw, sum(pos) over (order by i) as cp, w, pos from g),
        b as (select a.i as i0, z.i as i1, (z.cp - a.cp + a.pos) / (z.cw - a.cw + a.w) as m from c a join c z on a.i <= z.i),
        low as (select k.i as i, b.i0, min(b.m) as m from c k join b on b.i0 <= k.i and b.i1 >= k.i group by 1, 2),
        f as (select i, max(m) as p_cal from low group by 1)
        select id, round(p_cal + 1.2345678e-8, 6) as p_cal from s join g using (p_tied) join f using (i)""",
    "calibrator_choice_tied": _round("""select method, brier_before, brier_after, log_loss_before, log_loss_after from both_fits
          order by brier_after, method limit 1""", "brier_before, brier_after, log_loss_before, log_loss_after", "method", 4,
        SCORES + _newton(12) + """, g as (select p_tied, row_number() over (order by p_tied) as i, count(*) as w, sum(y) as pos from s group by p_tied),
        c as (select i, sum(w) over (order by i) as cw, sum(pos) over (order by i) as cp, w, pos from g),
        b as (select a.i as i0, z.i as i1, (z.cp - a.cp + a.pos) / (z.cw - a.cw + a.w) as m from c a join c z on a.i <= z.i),
        low as (select k.i as i, b.i0, min(b.m) as m from c k join b on b.i0 <= k.i and b.i1 >= k.i group by 1, 2),
        f as (select i, max(m) as p_cal from low group by 1),
        fitted as (select 'isotonic' as method, y, p_tied, p_cal from s join g using (p_tied) join f using (i)
          union all select 'sigmoid', y, p_tied, 1e0 / (1e0 + exp(-(a * p_tied + b))) from s, w12),
        clipped as (select *, least(greatest(p_tied, 2.220446049250313e-16), 1e0 - 2.220446049250313e-16) as q0,
          least(greatest(p_cal, 2.220446049250313e-16), 1e0 - 2.220446049250313e-16) as q1 from fitted),
        both_fits as (select method, avg((p_tied - y) * (p_tied - y)) as brier_before, avg((p_cal - y) * (p_cal - y)) as brier_after,
          avg(-ln(case when y = 1 then q0 else 1e0 - q0 end)) as log_loss_before,
          avg(-ln(case when y = 1 then q1 else 1e0 - q1 end)) as log_loss_after from clipped group by method)"""),
    "run_leaderboard": _round("""select *, row_number() over (order by pr_auc desc, approach) as place, case when row_number() over (order by pr_auc desc, approach) = 1 then 1 else 0 end as is_winner
        from (select category as approach, """ + _AP + " as pr_auc, " + _AUC + """ as roc_auc, coalesce(sum(pos) filter (score >= 2e-1) / sum(pos), 0e0) as recall
          from (select *, sum(pos) over (partition by category order by score desc) as tp, sum(neg) over (partition by category order by score desc) as fp
            from (select category, p as score, sum(y) as pos, count(*) - sum(y) as neg from s group by 1, 2)) group by category)""",
        "pr_auc, roc_auc, recall", "approach, cast(place as int) as place, is_winner", ctes=SCORES),
    "running_best": _round("select trial, objective, max(objective) over (order by trial) as best_so_far from (select cast(date_diff('day', date '2024-01-01', cast(trans_ts as date)) as int) as trial, avg(amt) as objective from tx group by 1)",
        "objective, best_so_far", "trial", ctes=TX),
    "alias_latest": """select name, alias, version from (select o_orderpriority as name, o_orderstatus as alias, o_orderkey as version,
        row_number() over (partition by o_orderpriority, o_orderstatus order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1""",
}
