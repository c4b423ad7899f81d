"""SQL that gives the registered queries' results from the same tables.

Written from the tables' columns, not from the Spark code: it shares no
expression with it. A query without an entry has results that differ from run
to run (file names and times).
"""

# One message per event.
_TOPIC = "case when user_id % 2 = 0 then 'topic-json' else 'topic-parq' end"

_EVENT = """'iot_device_' || (user_id % 50 + 1) as device_id, (20 + event_id % 81)::int as battery_level,
  event_id % 2 = 0 as motion_detected, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as "timestamp" """

_KEYS = """cast(ts as date) as "date",
  extract(hour from ((ts at time zone 'UTC') at time zone 'America/Chicago'))::int as "hour" """

_LAKE = f"select {_EVENT}, {_KEYS} from events"

# Event with topic, client and window.
_SENT = f"""select *, topic || '-p' || (user_id % 4 + 1) as client_id, time_bucket(interval '1 hour', ts) as window_start
  from (select *, {_TOPIC} as topic from events)"""

_FAILED = "count(*) filter (event_type = 'error')"

# A damaged message's fields, by event type.
_BROKEN = "event_type in ('error', 'signup')"
_DAMAGED = f"""select case when {_BROKEN} then null else device_id end as device_id,
  case when {_BROKEN} or event_type = 'click' then null else battery_level end as battery_level,
  case when {_BROKEN} then null else motion_detected end as motion_detected,
  case when {_BROKEN} then null when event_type = 'purchase' then 'yesterday' else "timestamp" end as "timestamp",
  case when {_BROKEN} or event_type = 'purchase' then null else "date" end as "date",
  case when {_BROKEN} or event_type = 'purchase' then null else "hour" end as "hour",
  event_type, event_id, user_id
from (select {_EVENT}, {_KEYS}, event_type, event_id, user_id from events)"""

# A message's JSON text.
_TEXT = """'{"device_id":"' || device_id || '","battery_level":' || battery_level || ',"motion_detected":' ||
  motion_detected || ',"timestamp":"' || "timestamp" || '"}'"""

# Samples: a message rate each, and an error rate of failed ones.
_SAMPLES = f"""select ts, metric, topic, topic || '-p' || (user_id % 4 + 1) as client_id,
  case when user_id % 3 = 0 then 'ckafka' else '' end as impl, value, event_id,
  time_bucket(interval '1 hour', ts) as step
from (select *, {_TOPIC} as topic, 'kafka_producer_message_rate' as metric from events
  union all select *, {_TOPIC}, 'kafka_producer_error_rate' from events where event_type = 'error')"""

# The last sample of every series in a step.
_STEPPED = f"""select * from (select *, row_number() over (
  partition by step, metric, topic, client_id, impl order by ts desc, event_id desc) as rn from ({_SAMPLES}))
where rn = 1"""

_RATES = f"select * from ({_STEPPED}) where metric = 'kafka_producer_message_rate'"

_WINDOW = f"""select topic, client_id, window_start, window_start + interval '1 hour' as ts, count(*)::double as n,
  {_FAILED}::double as failed, sum(floor(value * 64) / 64) as delay
from ({_SENT}) group by topic, client_id, window_start"""


def _gauges(dropped: str) -> str:
    return f"""select ts, 'kafka_producer_message_rate' as metric, topic, client_id, n / 3600::double as value from w
  union all select ts, 'kafka_producer_dropped_messages', topic, client_id, {dropped} from w
  union all select ts, 'kafka_producer_error_rate', topic, client_id, failed / 3600::double from w
  union all select ts, 'kafka_producer_avg_delay', topic, client_id, delay / n from w"""


def _sum_by(names: str, condition: str = "true") -> str:
    return f"""select step, {names}, sum(value::decimal(20,2))::double as total from ({_RATES})
where {condition} group by step, {names}"""


# Expected normalised names per event type.
_NAMED = """select ts, value, {rule} as rule, {metric} as metric, {type} as type, {topic} as topic,
  {partition} as "partition", {client} as client_id, {gc} as gc_collector
from ({sent}) where event_type <> 'error'"""


def _named(**columns: str) -> str:
    return _NAMED.format(sent=_SENT, **columns)


_SAFE_TOPIC = "replace(topic, '-', '_')"
_GC = "case when event_type = 'purchase' then 'G1 Young Generation' else '' end"
_TYPE = "case when event_type = 'purchase' then 'COUNTER' else 'GAUGE' end"

# Where a client is scraped.
_INSTANCE = """'host.docker.internal:91' || case when user_id % 3 = 0 then '1' else '0' end ||
  case when user_id % 2 = 0 then '8' else '9' end"""

# Damaged payloads as they were sent.
_DISTINCT_DAMAGED = f"""select distinct case d.event_type when 'error' then substring(t.text, 1, 30) when 'signup' then 'signup'
    when 'click' then regexp_replace(t.text, '"battery_level":([0-9]+)', '"battery_level":"\\1"')
    when 'purchase' then regexp_replace(t.text, '"timestamp":"[^"]*"', '"timestamp":"yesterday"') else t.text end as raw,
  d.device_id, d.battery_level, d.motion_detected, d."timestamp"
from ({_DAMAGED}) d join (select event_id, {_TEXT} as text from (select {_EVENT}, event_id from events)) t using (event_id)"""

_TAIL = f"""select null::varchar as "key", {_TEXT} as value, ts as "timestamp"
from (select {_EVENT}, ts from events)"""

# Sends that are accepted, and the reports that come in time: up to 90 minutes later.
_ACCEPTED = f"select *, floor(value * 64) / 64 as delay from ({_SENT}) where event_type <> 'signup'"
_TOLD = f"""select *, ts + to_minutes((event_id % 7 * 20)::int) as told from ({_ACCEPTED})
  where event_id % 11 <> 0 and event_id % 7 * 20 <= 90"""
_REPORTED = f"""select topic, client_id, window_start, sum(sent)::bigint as msg_count, sum(sent)::double / 3600::double as rate,
  sum(failed)::bigint as error_count, sum(failed)::double / 3600::double as error_rate, 0::bigint as dropped_count,
  case when sum(sent) = 0 then 0::double else sum(delay) / sum(sent) end as avg_delay
from (select topic, client_id, window_start, 1 as sent, 0 as failed, delay from ({_ACCEPTED})
  union all select topic, client_id, time_bucket(interval '1 hour', told), 0, 1, 0 from ({_TOLD}) where event_type = 'error')
group by 1, 2, 3"""

# What a stream has closed once it has read everything: all that ends ten seconds before the last time or earlier.
_CLOSED = "window_start + interval '1 hour' <= (select max(ts) - interval '10 seconds' from events)"

# Sessions of a client: a message an hour or more after the one before starts a new one.
_ZEROS = f"""select max(ts) + interval '2 seconds' as ts, metric, topic, client_id, 0::double as value, max(ts) as last
from (select *, sum(fresh) over (partition by topic, client_id order by ts, event_id) as session
  from (select *, case when ts - lag(ts) over (partition by topic, client_id order by ts, event_id) < interval '1 hour' then 0 else 1 end as fresh from ({_SENT}))),
  (values ('kafka_producer_message_rate'), ('kafka_producer_error_rate'), ('kafka_producer_avg_delay')) as m(metric)
group by topic, client_id, session, metric"""

_LOGGED = f"""select round(((epoch_us(window_start + interval '1 hour')
    - epoch_us(min(min(ts)) over (partition by topic)))::double / 1e6)::decimal(18,6), 2)::double as elapsed_seconds,
  round((count(*)::double / 3600)::decimal(18,10), 2)::double as rate, count(*) as msg_count,
  {_FAILED} as error_count, {_FAILED} as dropped_count,
  round((sum(floor(value * 64) / 64) / count(*))::decimal(18,10), 4)::double as avg_delay, '1' as run, topic, window_start
from ({_SENT}) group by topic, window_start"""

_NEWEST_LAMBDA = f"""select topic, greatest(0::double, value - 15) as lambda
from (select *, row_number() over (partition by topic order by ts desc, value desc) as rn from ({_SENT})) where rn = 1"""

# Messages in order, the first one an hour or more after each, and from the first message on one after the other.
_CLIENT_WINDOWS = f"""with recursive m as (
  select *, row_number() over (partition by topic, client_id order by ts, event_id) as i from ({_SENT})
), instants as (
  select topic, client_id, ts, min(i) as i from m group by all
), closing as (
  select a.topic, a.client_id, a.i, a.ts, b.i as next, b.ts as closed
  from m a asof join instants b on a.topic = b.topic and a.client_id = b.client_id and a.ts + interval '1 hour' <= b.ts
), w as (
  select * from closing where i = 1
  union all
  select c.* from w join closing c on c.topic = w.topic and c.client_id = w.client_id and c.i = w.next
)
select w.topic, w.client_id, w.ts as window_start, w.closed as window_end, count(*) as msg_count,
  count(*)::double / ((epoch_us(w.closed) - epoch_us(w.ts))::double / 1e6::double) as rate, {_FAILED} as error_count,
  ({_FAILED})::double / ((epoch_us(w.closed) - epoch_us(w.ts))::double / 1e6::double) as error_rate,
  sum(floor(value * 64) / 64) / count(*) as avg_delay
from w join m on m.topic = w.topic and m.client_id = w.client_id and m.i <= w.next and (m.i > w.i or w.i = 1)
group by w.topic, w.client_id, w.ts, w.closed"""

# For each number: the first rule that fits and its name, the most specific one and its name, type, and the labels of the latter.
# T stands for the topic, C for the client, P for the partition, E for the event's type; t, c in a name for the legal form.
_RULES = [
    (1, "server_replicamanager_leadercount", 1, "server_replicamanager_leadercount", ""),
    (1, "server_fetcher_bytespersec_topic_{t}", 2, "server_fetcher_bytespersec", "T"),
    (1, "server_produce_byterate_client_id_{c}", 3, "server_produce_byterate", "C"),
    (4, "network_socketserver_idlepercent", 4, "network_socketserver_idlepercent", ""),
    (4, "network_processor_idlepercent_networkprocessor_{p}", 5, "network_processor_idlepercent", "N"),
    (6, "request_totaltimems", 6, "request_totaltimems", "E"),
    (7, "controller_kafkacontroller_activecontrollercount", 7, "controller_kafkacontroller_activecontrollercount", ""),
    (8, "log_log_logendoffset", 8, "log_log_logendoffset", "TP"),
    (9, "log_log_size", 9, "log_log_size", "T"),
    (10, "cluster_partition_underreplicated", 10, "cluster_partition_underreplicated", ""),
    (11, "coordinator_groupmetadatamanager_numgroups", 11, "coordinator_groupmetadatamanager_numgroups", ""),
    (12, "replica_replica_lag", 12, "replica_replica_lag", "TP"),
    (1, "server_fetcherlagmetrics_client_id_{c}_topic_{t}_partition_{p}_consumerlag", 13, "fetcher_lag_metrics_consumerlag", "TPC"),
    (1, "server_brokertopicmetrics_messagesinpersec_topic_{t}", 14, "broker_topic_metrics_messagesinpersec", "T"),
    (1, "server_brokertopicmetrics_bytesinpersec", 15, "broker_topic_metrics_bytesinpersec", ""),
    (16, "jvm_memory_heapmemoryusage", 16, "jvm_memory_heapmemoryusage", ""),
    (17, "jvm_gc_collection_count", 17, "jvm_gc_collection_count", "G"),
    (18, "jvm_gc_collection_time", 18, "jvm_gc_collection_time", "G"),
    (19, "jvm_thread_threadcount", 19, "jvm_thread_threadcount", ""),
    (20, "jvm_os_openfiledescriptorcount", 20, "jvm_os_openfiledescriptorcount", ""),
]


def _every_rule(specific: bool) -> str:
    rows = []
    for k, (first, name, best, best_name, labels) in enumerate(_RULES):
        rule, text = (best, best_name) if specific else (first, name)
        # A rule that is hidden gives its labels to nothing.
        held = labels if rule == best else ""
        rows.append(f"({k}, {rule}, '{text if text.startswith('jvm') else 'kafka_' + text}', '{held}')")
    legal = "replace(replace(replace(r.name, '{{t}}', replace(topic, '-', '_')), '{{c}}', replace(client_id, '-', '_')), '{{p}}', (user_id % 3)::varchar)"
    of = lambda letter, value: f"case when contains(labels, '{letter}') then {value} else '' end"
    return f"""select event_id, value, rule, {legal.replace('{{', '{').replace('}}', '}')} as metric,
  case when rule in (17, 18) then 'COUNTER' else 'GAUGE' end as type, {of('T', 'topic')} as topic, {of('P', '(user_id % 3)::varchar')} as "partition",
  {of('C', 'client_id')} as client_id, {of('G', "'G1 Old Generation'")} as gc_collector, {of('N', '(user_id % 3)::varchar')} as network_processor,
  {of('E', 'event_type')} as request
from ({_SENT}) join (values {', '.join(rows)}) as r(k, rule, name, labels) on event_id % 21 = k"""


ORACLE = {
    "lake_rows": _LAKE,
    "lake_rows_utc_keys": f"""select {_EVENT}, cast(ts as date) as "date", extract(hour from ts)::int as "hour"
from events""",
    "lake_partitions": f"""select "date", "hour", count(*) as n from ({_LAKE}) group by 1, 2""",
    "tail_text": _TAIL,
    "replay_roundtrip": _TAIL,
    "damaged_rows": f"""select device_id, battery_level, motion_detected, "timestamp", "date", "hour"
from ({_DAMAGED})""",
    "malformed_rows": f"""select case when d.user_id % 2 = 0 then 'topic-json' else 'topic-parq' end as topic,
  (d.user_id % 3)::int as "partition", d.event_id as "offset", d.device_id, d.battery_level, d.motion_detected,
  d."timestamp", case when d.event_type = 'error' then substring(t.text, 1, 30)
    when d.event_type = 'signup' then 'signup' end as raw
from ({_DAMAGED}) d
  join (select event_id, {_TEXT} as text from (select {_EVENT}, event_id from events)) t using (event_id)
where d."date" is null""",
    "dedup_payload": f"select distinct {_EVENT} from events",
    "dedup_damaged": _DISTINCT_DAMAGED,
    "stream_dedup_damaged": _DISTINCT_DAMAGED,
    "odd_time_rows": """select 'iot_device_' || (user_id % 50 + 1) as device_id, case event_type
    when 'error' then strftime(ts, '%Y-%m-%dT%H') when 'signup' then strftime(ts, '%H:%M:%S')
    when 'click' then strftime(ts, 'T%H:%M') when 'purchase' then strftime(ts, '%Y-%m-%d')
    else strftime(ts, '%Y-%m-%d %H:%M:%S') end as "timestamp",
  case when event_type not in ('signup', 'click') then cast(ts as date) end as "date",
  case when event_type = 'purchase' then 0 else extract(hour from ts)::int end as "hour"
from events""",
    "producer_rate": f"""select topic, client_id, window_start, count(*) as msg_count,
  count(*)::double / 3600::double as rate, {_FAILED} as error_count, ({_FAILED})::double / 3600::double as error_rate,
  {_FAILED} as dropped_count
from ({_SENT}) group by 1, 2, 3""",
    "producer_topic_rate": f"""select topic, window_start, count(*) as msg_count,
  count(*)::double / 3600::double as rate, {_FAILED} as error_count, ({_FAILED})::double / 3600::double as error_rate,
  0::bigint as dropped_count
from ({_SENT}) group by 1, 2""",
    "planned_delay": f"""select topic, client_id, window_start, count(*) as msg_count,
  sum(floor(value * 64) / 64) / count(*) as avg_delay
from ({_SENT}) group by 1, 2, 3""",
    "producer_delay": f"""select topic, time_bucket(interval '1 day', ts) as window_start, count(*) as n,
  sum(gap)::double / 1e6::double / count(gap) as avg_delay
from (select topic, ts, epoch_us(ts) - epoch_us(lag(ts) over (partition by topic order by ts, event_id)) as gap
  from ({_SENT})) group by 1, 2""",
    "run_elapsed": f"""select topic, client_id, window_start,
  (epoch_us(window_start + interval '1 hour') - epoch_us(min(min(ts)) over (partition by topic)))::double
    / 1e6::double as elapsed_seconds
from ({_SENT}) group by 1, 2, 3""",
    "reported_rate": _REPORTED,
    # The join may still give an error 90 minutes behind the slower of sends and failed reports.
    "stream_reported_rate": f"""select * from ({_REPORTED})
where window_start + interval '1 hour' <= (select least((select max(ts) from ({_ACCEPTED})),
  (select max(ts + to_minutes((event_id % 7 * 20)::int)) from ({_ACCEPTED}) where event_type = 'error' and event_id % 11 <> 0)))
    - interval '90 minutes 10 seconds'""",
    "unreported_sends": f"select topic, client_id, ts, event_id as message_id from ({_ACCEPTED}) where event_id not in (select event_id from ({_TOLD}))",
    "client_windows": _CLIENT_WINDOWS,
    "session_zeros": f"select ts, metric, topic, client_id, value from ({_ZEROS})",
    "stream_stop_zeros": f"""select ts, metric, topic, client_id, value from ({_ZEROS})
where last + interval '1 hour' <= (select max(ts) - interval '10 seconds' from events)""",
    "stream_gaps": f"""select topic, window_start, count(*) as n, sum(gap)::double / 1e6::double / nullif(count(gap), 0) as avg_delay,
  (epoch_us(window_start + interval '1 hour') - min(first))::double / 1e6::double as elapsed_seconds
from (select *, epoch_us(ts) - epoch_us(lag(ts) over (partition by topic order by ts, event_id)) as gap,
    epoch_us(min(ts) over (partition by topic)) as first from ({_SENT}))
where {_CLOSED} group by 1, 2""",
    "stream_lambda_current": _NEWEST_LAMBDA,
    "lambda_current": _NEWEST_LAMBDA,
    "lambda_current_unclamped": f"""select topic, value - 15 as lambda
from (select *, row_number() over (partition by topic order by ts desc, value desc) as rn from ({_SENT})) where rn = 1""",
    "lambda_samples": f"""select ts, 'kafka_producer_lambda' as metric, topic, greatest(0::double, value - 15) as value
from ({_SENT})""",
    "metric_samples": f"with w as ({_WINDOW}) {_gauges('0::double')}",
    "stop_zeros": f"""with w as ({_WINDOW}), s as ({_gauges('failed')})
select * from s union all
select max(ts) + interval '2 seconds', metric, topic, client_id, 0::double from s
where metric <> 'kafka_producer_dropped_messages' group by metric, topic, client_id""",
    "sampled_steps": f"select step, metric, topic, client_id, impl, value from ({_STEPPED})",
    "rate_by_topic": _sum_by("topic"),
    "rate_by_topic_impl": _sum_by("topic, impl"),
    "rate_by_topic_impl_selected": _sum_by("topic, impl", "topic = 'topic-json' and impl in ('ckafka', 'kpython')"),
    "rate_by_impl": _sum_by("impl", "topic = 'topic-json'"),
    "series_select": f"""select ts, client_id as series, impl, value, event_id from ({_SAMPLES})
where metric = 'kafka_producer_message_rate' and topic = 'topic-json'
  and ts > timestamp '2024-01-14 12:00:00' and ts <= timestamp '2024-01-15 12:00:00'""",
    "error_by_client": f"""select ts, client_id as series, value, event_id from ({_SAMPLES})
where metric = 'kafka_producer_error_rate' and topic = 'topic-parq'""",
    "label_values": f"""select distinct 'topic' as label, topic as value from ({_SENT})
union all select distinct 'impl', 'ckafka' from ({_SENT}) where user_id % 3 = 0
union all select distinct 'instance', {_INSTANCE} from ({_SENT})""",
    "error_panel": f"""select ts, client_id, impl, value, event_id from ({_SAMPLES})
where metric = 'kafka_producer_error_rate' and topic = 'topic-json' and impl in ('ckafka', 'kpython')""",
    "value_by_type": f"""select step, metric, 'GAUGE' as type, topic, client_id, impl, max_by(value, ts) as value
from (select step, ts, metric, topic, client_id, impl, max(value) as value from ({_SAMPLES}) group by all)
where metric = 'kafka_producer_message_rate' group by all
union all
select step, metric, 'COUNTER', topic, client_id, impl, sum(case when value >= before then value - before when before is not null then value else 0 end)::double
from (select *, lag(value) over (partition by topic, client_id, impl order by ts) as before
  from (select step, ts, metric, topic, client_id, impl, max(value)::decimal(20,2) as value from ({_SAMPLES})
    where metric = 'kafka_producer_error_rate' group by all))
group by all""",
    "target_labels": f"""select ts, metric, event_id,
  case when topic = 'topic-json' then 'kpython' else impl end as impl,
  case when topic = 'topic-json' then impl else '' end as exported_impl,
  case when topic = 'topic-json' then 'producer-topic-json' else '' end as job_label
from ({_SAMPLES})""",
    "scraped_impl": f"""select ts, event_id, value,
  'kafka-producer-' || right(topic, 4) || case when user_id % 3 = 0 then '-ckafka' else '' end as job,
  {_INSTANCE} as instance, topic,
  case when user_id % 3 = 0 then 'ckafka' else '' end as impl
from ({_SENT})""",
    "normalize_names": _named(
        rule="case event_type when 'view' then 1 when 'click' then 8 when 'signup' then 1 else 17 end",
        metric=f"""case event_type
    when 'view' then 'kafka_server_brokertopicmetrics_messagesinpersec_topic_' || {_SAFE_TOPIC}
    when 'click' then 'kafka_log_log_logendoffset'
    when 'signup' then 'kafka_server_fetcherlagmetrics_client_id_' || replace(client_id, '-', '_') || '_topic_' ||
      {_SAFE_TOPIC} || '_partition_' || (user_id % 3) || '_consumerlag'
    else 'jvm_gc_collection_count' end""",
        type=_TYPE,
        topic="case when event_type = 'click' then topic else '' end",
        partition="case when event_type = 'click' then (user_id % 3)::varchar else '' end",
        client="''", gc=_GC),
    "normalize_names_specific": _named(
        rule="case event_type when 'view' then 14 when 'click' then 8 when 'signup' then 13 else 17 end",
        metric="""case event_type when 'view' then 'kafka_broker_topic_metrics_messagesinpersec'
    when 'click' then 'kafka_log_log_logendoffset' when 'signup' then 'kafka_fetcher_lag_metrics_consumerlag'
    else 'jvm_gc_collection_count' end""",
        type=_TYPE,
        topic="case when event_type = 'purchase' then '' else topic end",
        partition="case when event_type in ('click', 'signup') then (user_id % 3)::varchar else '' end",
        client="case when event_type = 'signup' then client_id else '' end", gc=_GC),
    "normalize_coordination": """select ts, value,
  case event_type when 'view' then 1 when 'click' then 3 when 'signup' then 5 else 7 end as rule,
  case event_type when 'view' then 'zookeeper_avg_request_latency' when 'click' then 'zookeeper_outstanding_requests'
    when 'signup' then 'zookeeper_watch_count'
    else 'org.apache.zookeeperservice<name0=replicatedserver_id' || (user_id % 3) || ',name1=replica.' ||
      (user_id % 5) || ',name2=leader>:electiontimetaken' end as metric,
  case when event_type in ('view', 'click', 'signup') then 'GAUGE' end as type
from events""",
    "normalize_every_rule": _every_rule(False),
    "normalize_every_rule_specific": _every_rule(True),
    "normalize_every_coordination_rule": """select event_id, value, (event_id % 7 + 1)::int as rule, case event_id % 7
    when 0 then 'zookeeper_avg_request_latency' when 1 then 'zookeeper_max_request_latency' when 2 then 'zookeeper_outstanding_requests'
    when 3 then 'zookeeper_num_alive_connections' when 4 then 'zookeeper_watch_count' when 5 then 'zookeeper_data_tree_size'
    else 'org.apache.zookeeperservice<name0=replicatedserver_id' || (user_id % 3) || ',name1=replica.' ||
      (user_id % 5) || ',name2=leader>:packetssent' end as metric,
  case when event_id % 7 < 6 then 'GAUGE' end as type
from events""",
    "topic_list": f"select distinct topic from ({_SENT})",
    "topic_inventory": f"select topic, count(distinct user_id % 3) as partitions from ({_SENT}) group by 1",
    "end_offsets": f"""select topic, (user_id % 3)::int as "partition", max(event_id) + 1 as end_offset
from ({_SENT}) group by 1, 2""",
    "consumer_lag": f"""select topic, (user_id % 3)::int as "partition", max(event_id) + 1 as end_offset,
  coalesce(max(event_id) filter (ts < timestamp '2024-01-25') + 1, 0) as committed,
  max(event_id) + 1 - coalesce(max(event_id) filter (ts < timestamp '2024-01-25') + 1, 0) as lag
from ({_SENT}) group by 1, 2""",
    "lake_json_roundtrip": _LAKE,
    "lake_parquet_roundtrip": _LAKE,
    "lake_damaged_roundtrip": f"""select device_id, battery_level, motion_detected, "timestamp", "date", "hour"
from ({_DAMAGED})""",
    "lake_range": f"""{_LAKE}
where ts >= timestamp '2024-01-10 03:30:00' and ts < timestamp '2024-01-12 07:15:00'""",
    "lake_hour": f"""select * from ({_LAKE}) where "date" = date '2024-01-15' and "hour" = 21""",
    "progress_log": "select 'logged' as name, count(*) as input_rows, 3::bigint as last_batch from events",
    "progress_rates": "select 'progress' as name, count(*) as input_rows from events",
    "recent_batches": """select * from (values (1, 0, true), (2, 0, true), (3, 0, true)) as v(batch_id, source, committed)
where exists (select * from events)""",
    "newest_files": f"""select distinct "date", "hour" from ({_LAKE}) where day("date") > 24""",
    "stream_lake_parts": f"""select "date", "hour", count(*) as n from ({_LAKE}) group by 1, 2""",
    "stream_producer_rate": f"""select topic, client_id, window_start, count(*) as msg_count,
  count(*)::double / 3600::double as rate, {_FAILED} as error_count,
  sum(floor(value * 64) / 64) / count(*) as avg_delay
from ({_SENT})
where window_start + interval '1 hour' <= (select max(ts) - interval '10 seconds' from events) group by 1, 2, 3""",
    "stream_dedup_payload": f"select distinct {_EVENT} from events",
    "metrics_csv_roundtrip": f"select * exclude (window_start) from ({_LOGGED})",
    "stream_metrics_log": f"select * exclude (window_start) from ({_LOGGED}) where {_CLOSED}",
}
