"""The operators as registered queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    cotraining,
    exact,
    language_id,
    lexical,
    minhash,
    mixing,
    packing,
    pitman_yor,
    quality_rules,
    repair,
    rollup,
    shards,
    substring,
)
from tidemark.session import new_folder



def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.report(_documents(spark, folder))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substring.remove_repeats(_documents(spark, folder).select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(_documents(spark, folder))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.decisions(_documents(spark, folder))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.report(_documents(spark, folder), percent=85).drop("key")


def op6_pitman_yor_scores(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score(_documents(spark, folder))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text", "source", "lang")
    found = cotraining.classify(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return found.select("doc_id", "p_quality", "p_toxic", "kept")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents inserted as they were, then revised; a third deleted and inserted again; and the totals after that.

    What a document was before its revision is made from it: half of its text, of no known
    language. Each batch is delivered twice; the second delivery finds it committed.
    """
    table, docs = new_folder(spark, "token-counts"), _documents(spark, folder)
    half = (F.char_length("text") / 2).cast("int")
    before = docs.withColumn("text", F.col("text").substr(F.lit(1), half)).withColumn("lang", F.lit(None).cast("string"))
    third = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    old, new, some = (rollup.counts(d, rollup.production_versions()) for d in (before, docs, third))
    batches = {
        "insert": rollup.changes(inserted=old),
        "revise": rollup.changes(revised=(old, new)),
        "delete": rollup.changes(deleted=some),
        "again": rollup.changes(inserted=some),
    }
    for batch, signed in batches.items():
        for _ in range(2):
            rollup.commit(table, batch, signed)
    return rollup.totals(spark, table)


def op9_training_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.write_shards(_documents(spark, folder), new_folder(spark, "shards"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.best_fit(_documents(spark, folder))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.report(spark.read.parquet(f"{folder}/conversations.parquet"))


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.report(_documents(spark, folder))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_pitman_yor_scores": op6_pitman_yor_scores,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_training_shards": op9_training_shards,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_lexical_search": op11_lexical_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_language_id": op13_language_id,
}

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
# documents with their words; windows of 8 words that a text holds twice or more
_RULES = r"""
    with d as (
        select doc_id, coalesce(text, '') as t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
        from documents),
    win as (
        select doc_id, i, array_to_string(w[i : i + 7], ' ') as s
        from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d)),
    twice as (
        select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as n from win)
        where n > 1),
    repeats as (
        select doc_id, count(distinct p) as n
        from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by 1),
    l as (
        select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
        from d),
    m as (
        select d.doc_id, len(w) as n_words,
            coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
            len(l) - len(list_distinct(l)) as n_dup_lines,
            coalesce(r.n, 0) as n_repeat_words, len(l) as n_lines,
            len(regexp_extract_all(t, '[A-Z]')) as upper, len(regexp_extract_all(t, '[A-Za-z]')) as letters
        from d join l using (doc_id) left join repeats r using (doc_id)),
    b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words
            or word_chars > 12 * n_words or 10 * n_dup_lines > 3 * n_lines
            or 100 * upper // greatest(letters, 1) > 50) as kept
    from b
"""
_REPEATS = r"""
    with d as (
        select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
    win as (
        select doc_id, i, array_to_string(w[i : i + 12], ' ') as s
        from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
    hit as (
        select doc_id, i from (select doc_id, i, min(doc_id) over (partition by s) as m from win)
        where doc_id > m),
    gone as (select distinct doc_id, unnest(range(i, i + 13)) as p from hit),
    left_over as (
        select doc_id, string_agg(x, ' ' order by p) as t
        from (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from d)
            anti join gone using (doc_id, p)
        group by 1),
    n as (select doc_id, count(*) as n from gone group by 1)
    select doc_id, len(w) as n_words, coalesce(n.n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
    from d left join n using (doc_id) left join left_over using (doc_id)
"""
_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
_RANKED = f"""
    with i as (select distinct item_id, unnest({_TERMS}) as t from benchmark),
    d as (select doc_id, {_TERMS} as w from documents where text is not null),
    s as (select count(*) as n, sum(len(w))::bigint as l from d where len(w) > 0),
    p as (
        select doc_id, t, count(*) as tf from (select doc_id, unnest(w) as t from d)
        where t in (select t from i) group by 1, 2),
    v as (
        select t, floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1)))::bigint as w from p, s group by t, s.n),
    m as (select doc_id, 10 + (90 * len(w) * s.n) // s.l as m from d, s where len(w) > 0),
    r as (
        select item_id, doc_id, sum(v.w * ((1000000000 * tf) // (1000 * tf + 8 * m.m)))::bigint as score
        from i join p using (t) join v using (t) join m using (doc_id) group by 1, 2)
    select item_id, rank::int as rank, doc_id, score
    from (
        select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
        from r where score > 0)
    where rank <= 10
"""


def _plus(state: str, cost: str, audit: str) -> str:
    """A state, which is a cost of nine digits and an audit, after one more edit."""
    return f"printf('%09d', substr({state}, 1, 9)::bigint + {cost}) || substr({state}, 10) || {audit}"


def _inserted(n0: str, n1: str, n2: str, n3: str) -> str:
    """The four states with insertions after them."""
    ii = [_plus(n, "4", "'II'") for n in (n0, n1)]
    i0, i1, i2, i3 = (_plus(n, "2", "'I'") for n in (n0, n1, n2, n3))
    return f"[{n0}, {n1}, least({n2}, {i0}, {i1}, {i3}), least({n3}, {i2}, {', '.join(ii)})]"


def _edited(a: str, x: str) -> str:
    """The four states (nothing, after s, after u, after a) after one row: initial, gone, truncated."""
    never, cut = "'800000000'", f"{x}[3]::bigint"

    def to(role: str, state: str) -> str:
        kept, renamed = _plus(state, cut, "'K'"), _plus(state, f"2 + {cut}", "'R'")
        return f"case when {x}[2] = '1' then {never} when {x}[1] = '{role}' then {kept} else {renamed} end"

    deleted = [_plus(f"{a}[{i}]", "3", "'D'") for i in (1, 2, 3, 4)]
    system = f"case when {x}[2] = '0' and {x}[1] = 's' then {_plus(f'{a}[1]', cut, repr('K'))} else {never} end"
    user = ", ".join(to("u", f"{a}[{i}]") for i in (1, 2, 4))
    return f"""[{deleted[0]}, least({deleted[1]}, {system}), least({deleted[2]}, {user}),
        least({deleted[3]}, {to('a', f'{a}[3]')})]"""


# the cheapest repair, row by row over the states of a conversation
_REPAIRED = f"""
    with tab as (
        select list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as tab
        from (select unnest(range(256)) as n)),
    marked as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            xor(list_reduce([4294967295] || list_transform(
                string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
                lambda x: ascii(x)::bigint),
                lambda c, b: xor(tab[1 + (xor(c, b) & 255)], c >> 8)), 4294967295) % 20 as k
        from conversations, tab),
    damaged as (
        select conv_id, turn, copy, case when k = 4 then 'user' else role end as role,
            case when k = 1 then '' when k = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
        from (select *, unnest(case when k = 3 then [0, 1] else [0] end) as copy from marked where k <> 0)),
    placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as pos,
            regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) as tail
        from damaged),
    faults as (
        select *, tail = '' as blank, row_number() over (partition by conv_id, role, text order by pos) > 1 as again,
            lag(role) over (partition by conv_id order by pos) as before
        from placed),
    flagged as (
        select *, not blank and again as duplicate, not blank and not again and tail not in ('.', '!', '?') as truncated
        from faults),
    convs as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
            count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
            count(*) filter (truncated) as truncated,
            count(*) filter (before is not null and substr(before, 1, 1) || substr(role, 1, 1) not in ('su', 'ua', 'au')) as illegal,
            list([substr(role, 1, 1), (blank or duplicate)::int::varchar, truncated::int::varchar] order by pos) as rows
        from flagged group by conv_id),
    ends as (
        select *, list_reduce([['000000000', '800000000', '000000002I', '000000004II']] || rows,
            lambda a, x: list_transform([{_edited("a", "x")}], lambda n: {_inserted("n[1]", "n[2]", "n[3]", "n[4]")})[1]) as e
        from convs),
    best as (select * exclude (rows, e), least(e[1], e[4]) as b from ends),
    edits as (
        select conv_id, edit, place, sum((edit <> 'I')::int) over w as pos, sum((edit <> 'D')::int) over w as n
        from (
            select conv_id, unnest(string_split(substr(b, 10), '')) as edit,
                generate_subscripts(string_split(substr(b, 10), ''), 1) as place
            from best where length(b) > 9)
        window w as (partition by conv_id order by place)),
    made as (
        select e.conv_id, e.edit, e.place, e.n, f.role, f.text,
            max((e.n = 1 and e.edit = 'K' and substr(f.role, 1, 1) = 's')::int) over (partition by e.conv_id) as sys
        from edits e left join flagged f on e.edit <> 'I' and f.pos = e.pos and f.conv_id is not distinct from e.conv_id),
    hashes as (
        select conv_id, sha256(string_agg(
            case when edit = 'K' then role when (n - sys) % 2 = 1 then 'user' else 'assistant' end || ':' ||
            case when edit = 'I' then '' else text end, chr(10) order by place)) as h
        from made where edit <> 'D' group by conv_id)
    select c.conv_id, coalesce(b.gaps, 0)::bigint as gaps, coalesce(b.blank, 0)::bigint as blank,
        coalesce(b.duplicate, 0)::bigint as duplicate, coalesce(b.truncated, 0)::bigint as truncated,
        coalesce(b.illegal, 0)::bigint as illegal, coalesce(substr(b.b, 1, 9)::bigint, 0) as cost,
        coalesce(substr(b.b, 10), '') as audit, coalesce(h.h, sha256('')) as repaired_sha256
    from (select distinct conv_id from conversations) c
        left join best b on b.conv_id is not distinct from c.conv_id
        left join hashes h on h.conv_id is not distinct from c.conv_id
"""
ORACLES = {
    "op2_substring_dedup": _REPEATS,
    "op1_quality_rules": _RULES,
    "op11_lexical_search": _RANKED,
    "op12_conversation_repair": _REPAIRED,
    "op4_exact_dedup": f"""
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
            row_number() over (partition by t order by doc_id desc) = 1 as kept,
            sha256(t) as text_sha256
        from (select doc_id, {_LOWER} as t from documents) window g as (partition by t)
    """,
    "op5_minhash_near_dedup": rf"""
    with recursive d as (
        select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
    sh as (
        select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
    n as (select doc_id, count(*) as n from sh group by 1),
    shared as (
        select a.doc_id as a, b.doc_id as b, count(*) as k
        from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    links as (
        select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b
        where 100 * k >= 85 * (x.n + y.n - k)),
    edges as (select a, b from links union all select b, a from links),
    reach as (
        select doc_id as a, doc_id as b from d union select r.a, e.b from reach r join edges e on r.b = e.a),
    c as (select a as doc_id, min(b) as component_id from reach group by 1)
    select doc_id, coalesce(n.n, 0) as n_shingles, component_id, doc_id = component_id as kept
    from c left join n using (doc_id)
    """,
}
