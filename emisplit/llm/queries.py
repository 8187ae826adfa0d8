"""One query per operator over its whole table, and the SQL to compare it with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emisplit.llm import conversation_repair, decontaminate, hamming_search, html_extract, langid, license_scan, line_chunks, minhash, mixing
from emisplit.llm import prefix_trie, secret_scan, sentence_spans, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.search(_table(spark, sf_dir, "embeddings"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sentence_spans.dedup_spans(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "text", "n_sentences", "removed_sentences")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_chunks.dedup_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "text", "removed_lines", "removed_chunks")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find(_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.capture_index(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.hit_words(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``draws``: the output shard of every copy of the document that the mix takes."""
    rows = mixing.mix(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "draws")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_tree(_table(spark, sf_dir, "conversations"))


def op12_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(turns), turns)


def queries() -> dict[str, Query]:
    return {
        "op1_hamming_topk": op1_hamming_topk,
        "op2_html_extract": op2_html_extract,
        "op3_sentence_spans": op3_sentence_spans,
        "op4_line_dedup": op4_line_dedup,
        "op5_secrets": op5_secrets,
        "op6_warc": op6_warc,
        "op7_minhash": op7_minhash,
        "op8_decontaminate": op8_decontaminate,
        "op9_langid": op9_langid,
        "op10_mixing": op10_mixing,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_license": op12_license,
        "op13_repair": op13_repair,
    }


_OP1 = """
with c as (
  select distinct vec_id as id, array_to_string(list_transform(embedding, lambda x: case when x > 0 then '1' else '0' end), '') as code
  from embeddings where vec_id is not null and embedding is not null
), pairs as (
  select q.id as query_id, n.id as neighbor_id, hamming(q.code, n.code)::integer as distance
  from c q join c n on n.id <> q.id where q.id % 50 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by distance, neighbor_id)::integer as rank from pairs
)
select query_id, rank, neighbor_id, distance from ranked where rank <= 10
"""

_OP3 = r"""
with parts as (
  select doc_id, list_filter(regexp_extract_all(text, '(?:[^ \t\r\n]*[^ \t\r\n.!?][ \t\r]+){0,11}[^ \t\r\n]*[ \t\r\n]*'),
                             lambda x: x <> '') as u
  from documents
), spans as (
  select doc_id, i, concat_ws(' ', rtrim(u[i], e' \t\r\n'), rtrim(u[i + 1], e' \t\r\n'), rtrim(u[i + 2], e' \t\r\n')) as k
  from (select doc_id, u, unnest(range(1, len(u) - 1)) as i from parts where len(u) >= 3)
), ranked as (
  select *, row_number() over (partition by k order by doc_id, i) as n from spans where length(k) >= 40
), gone as (
  select distinct doc_id, unnest([i, i + 1, i + 2]) as i from ranked where n > 1
), kept as (
  select s.doc_id, string_agg(s.x, '' order by s.i) as text, count(*) as n
  from (select doc_id, u[i] as x, i from (select doc_id, u, unnest(range(1, len(u) + 1)) as i from parts)) s
  anti join gone g on g.doc_id = s.doc_id and g.i = s.i
  group by s.doc_id
)
select d.doc_id, case when d.text is not null then coalesce(k.text, '') end as text,
       coalesce(len(p.u), 0)::bigint as n_sentences, (coalesce(len(p.u), 0) - coalesce(k.n, 0))::bigint as removed_sentences
from documents d left join parts p using (doc_id) left join kept k using (doc_id)
"""

_OP4 = """
with lines as (
  select doc_id, i, l[i] as line, len(l) as n
  from (select doc_id, l, unnest(range(1, len(l) + 1)) as i from (select doc_id, string_split(text, chr(10)) as l from documents))
), hashed as (
  select *, ('0x' || substr(md5(line), 1, 13))::bigint as h from lines
), ended as (
  select doc_id, i, line,
         i = n or (i >= 2 and (h + 2 * lag(h, 1, 0) over (partition by doc_id order by i)) % 3 = 0) as is_end
  from hashed
), numbered as (
  select doc_id, i, line,
         coalesce(sum(is_end::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as c
  from ended
), chunks as (
  select doc_id, c, min(i) as first, count(*) as size, string_agg(line, chr(10) order by i) as body
  from numbered group by doc_id, c
), ranked as (
  select *, row_number() over (partition by body order by doc_id, first) as k from chunks where size > 1
), gone as (
  select doc_id, c, size from ranked where k > 1
), kept as (
  select n.doc_id, string_agg(n.line, chr(10) order by n.i) as text
  from numbered n anti join gone g on g.doc_id = n.doc_id and g.c = n.c group by n.doc_id
), lost as (
  select doc_id, sum(size) as removed_lines, count(*) as removed_chunks from gone group by doc_id
)
select d.doc_id, case when d.text is not null then coalesce(k.text, '') end as text,
       coalesce(removed_lines, 0)::bigint as removed_lines, coalesce(removed_chunks, 0)::bigint as removed_chunks
from documents d left join kept k using (doc_id) left join lost using (doc_id)
"""

_OP6 = """
with p as (
  select page_id, coalesce(html, '') as html from pages
), s as (
  select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest,
         max(page_id) over (partition by html) as kept
  from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < kept then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < kept then kept end as refers_to
from s
"""


_OP7 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, array_to_string(list_slice(w, i, i + least(len(w), 5) - 1), ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
), links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select reach.a, links.b from reach join links on links.a = reach.b
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d left join sizes using (doc_id)
join (select a as doc_id, min(b) as component_id from reach group by a) c using (doc_id)
"""

_OP8 = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as size, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
), sizes as (
  select distinct size from windows
), places as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from d, sizes where len(w) >= size
), found as (
  select p.doc_id, p.i, p.size, x.item_id
  from places p join windows x on x.size = p.size and x.win = array_to_string(list_slice(p.w, p.i, p.i + p.size - 1), ' ')
), hit as (
  select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + size)) as k from found) group by doc_id
), items as (
  select doc_id, count(distinct item_id) as n_items,
         array_to_string(list_sort(list(distinct item_id::varchar)), ',') as ids
  from found group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
"""


#: CRC-32 of an ASCII text, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split({text}, ''), lambda x: unicode(x)::bigint),
           lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[],
                                    lambda x, k: case when x % 2 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end, xor(c, b)),
           4294967295::bigint), 4294967295::bigint)"""

_OP11 = r"""
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
  from conversations where conv_id is not null
), lists as (
  select conv_id, list(struct_pack(role := role, text := text) order by i) as l from own group by conv_id
), heads as (
  select conv_id, l, conv_id - conv_id % 5 as base, {crc} % 9 as h from lists
), built as (
  select c.conv_id, list_concat(coalesce(list_slice(b.l, 1, c.h), []), coalesce(list_slice(c.l, c.h + 1, len(c.l)), [])) as s
  from heads c left join lists b on b.conv_id = c.base
), prefixes as (
  select conv_id, d, list_slice(s, 1, d) as k, len(s) = d as ends from (select conv_id, s, unnest(range(0, len(s) + 1)) as d from built)
), nodes as (
  select k, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256,
         case when d > 0 then strlen(k[d].text) else 0 end as bytes
  from prefixes group by k, d
), kids as (
  select list_slice(k, 1, depth - 1) as k, count(*) as n from nodes where depth > 0 group by 1
), above as (
  select list_slice(k, 1, unnest(range(0, depth + 1))) as k, k as below from nodes
), sums as (
  select a.k, count(*) filter (c.n is null) as n_leaves, sum((b.n_convs - 1) * b.bytes) as saved
  from above a join nodes b on b.k = a.below left join kids c on c.k = a.below group by a.k
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs, coalesce(c.n, 0)::bigint as n_children,
       n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, n.ends_sha256
from nodes n join sums s on s.k = n.k left join kids c on c.k = n.k
left join nodes p on n.depth > 0 and p.k = list_slice(n.k, 1, n.depth - 1)
"""


_OP12 = r"""
with t as (
  select label, string_split(words, ' ') as w, exact, must from (values
    {templates}
  ) v(label, words, exact, must)
), known as (
  select row_number() over () as template, *, len(w) - 2 as runs from t
), asked as (
  select template, q, w[q + 1] || ' ' || w[q + 2] || ' ' || w[q + 3] as gram
  from (select template, w, unnest(range(0, len(w) - 2)) as q from known)
), d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), grams as (
  select doc_id, place, w[place + 1] || ' ' || w[place + 2] || ' ' || w[place + 3] as gram
  from (select doc_id, w, unnest(range(0, len(w) - 2)) as place from d where len(w) > 2)
), lines as (
  select doc_id, template, place - q as diagonal, list(q) as ats from grams join asked using (gram) group by all
), judged as (
  select *, case when exact or diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) <= 4 is not true
                 then 1 else 0 end as opens
  from lines join known using (template) where len(ats) >= case when exact then runs else 2 end
), islands as (
  select *, sum(opens) over (partition by doc_id, template order by diagonal) as island from judged
), spans as (
  select doc_id, label, exact, min(diagonal + list_min(ats)) as first,
         len(list_distinct(flatten(list(ats)))) / any_value(runs) as cover
  from islands group by doc_id, template, label, exact, must, w, island
  having len(list_distinct(flatten(list(ats)))) >= 0.75 * any_value(runs)
     and (exact or list_contains(list_transform(flatten(list(ats)), lambda q: array_to_string(w[q + 1 : q + 3], ' ')), must))
), found as (
  select doc_id, count(*) filter (exact) as n_base, min(first) filter (exact) as first_word, max(first) filter (exact) as last_word,
         array_to_string(list_sort(list(distinct label) filter (exact)), ',') as base_labels,
         array_to_string(list_sort(list(distinct label)), ',') as labels, max(cover) as score
  from spans group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
       last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       coalesce(score, 0)::double as score
from d left join found using (doc_id)
"""


# Forward over the turns with the best (cost, edits, lines) per state, where the query goes backward.
_OP13 = r"""
with recursive fates as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc} % 20 as fate from conversations
), damaged as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
         case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case when fate = 3 then 2 else 1 end)) as copy
  from fates where fate <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged
), copied as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again from placed
), faults as (
  select conv_id, i, turn, role, text, left(role, 1) as r,
         case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when again then 'duplicate'
              when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' else '' end as fault,
         i > 1 and not coalesce(lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1), '') in ('su', 'ua', 'au') as illegal
  from copied
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
         count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (illegal) as illegal
  from faults group by conv_id
), walk as (
  select conv_id, 0::bigint as i, {start} as s
  from (select distinct conv_id from conversations)
  union all
  select conv_id, i, [s[1], s[2], {put2}, {put3}] as s from (
    select conv_id, i, [s[1], s[2], s[3], s[4], {put2}] as s from (
      select w.conv_id, f.i, [
        {n0}, {n1}, {n2}, {n3}
      ] as s
      from walk w join faults f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1
    )
  )
), ended as (
  select conv_id, list_sort([s[1], s[4]])[1] as best from walk
  qualify row_number() over (partition by conv_id order by i desc) = 1
)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, best.cost::bigint as cost,
       best.audit as audit, sha256(array_to_string(best.lines, chr(10))) as repaired_sha256
from ended e left join counted c on c.conv_id is not distinct from e.conv_id
"""


def _op13() -> str:
    def made(old: str, cost: str, edit: str, line: str | None, when: str = "true") -> str:
        lines = f"list_append({old}.lines, {line})" if line else f"{old}.lines"
        return (
            f"struct_pack(cost := case when {when} then {old}.cost + {cost} else 1000000000 end,"
            f" audit := {old}.audit || '{edit}', lines := {lines})"
        )

    least = lambda *ways: "list_sort([" + ", ".join(ways) + "])[1]"
    kept = "f.fault in ('', 'truncated')"
    extra = "(f.fault = 'truncated')::int"
    own = "f.role || ':' || f.text"
    gone = [made(f"s[{i}]", "3", "D", None) for i in (1, 2, 3, 4)]
    keep = lambda i, r: made(f"s[{i}]", extra, "K", own, f"f.r = '{r}' and {kept}")
    other = lambda i, r: made(f"s[{i}]", f"2 + {extra}", "R", f"'{r}:' || f.text", kept)
    put = lambda i, r: made(f"s[{i}]", "2", "I", f"'{r}:'")
    state = lambda cost, audit, lines: f"struct_pack(cost := {cost}, audit := '{audit}', lines := {lines}::varchar[])"
    start = ", ".join(
        [state(0, "", "[]"), state(1000000000, "", "[]"), state(2, "I", "['user:']"), state(4, "II", "['user:', 'assistant:']")]
    )
    parts = {
        "crc": _CRC.replace("{text}", "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"),
        "start": f"[{start}]",
        "n0": gone[0],
        "n1": least(gone[1], keep(1, "s")),
        "n2": least(gone[2], *[w(i, r) for w, r in ((keep, "u"), (other, "user")) for i in (1, 2, 4)]),
        "n3": least(gone[3], keep(3, "a"), other(3, "assistant")),
    }
    sql = _OP13
    for name, text in parts.items():
        sql = sql.replace("{" + name + "}", text)
    # First a user's turn put in, then an assistant's after it.
    first, second = least("s[3]", put(1, "user"), put(2, "user"), put(4, "user")), least("s[4]", put(5, "assistant"))
    outer, inner = sql.index("{put2}"), sql.rindex("{put2}")
    sql = sql[:inner] + first + sql[inner + 6 :]
    return (sql[:outer] + "s[5]" + sql[outer + 6 :]).replace("{put3}", second)


def _op12() -> str:
    rows = [(label, words, "true", "") for label, words in license_scan.PHRASES]
    rows += [(label, words, "false", must) for label, words, must in license_scan.NOTICES]
    return _OP12.replace("{templates}", ",\n    ".join(f"('{a}', '{b}', {c}, '{d}')" for a, b, c, d in rows))


def oracle_sql() -> dict[str, str]:
    return {"op1_hamming_topk": _OP1, "op3_sentence_spans": _OP3, "op4_line_dedup": _OP4, "op6_warc": _OP6, "op7_minhash": _OP7, "op8_decontaminate": _OP8, "op11_prefix_trie": _OP11.replace("{crc}", _CRC.replace("{text}", "conv_id::varchar")), "op12_license": _op12(), "op13_repair": _op13()}
