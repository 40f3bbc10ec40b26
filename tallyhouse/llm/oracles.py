"""The same results in SQL, for the text queries that SQL can express."""

from __future__ import annotations

LINE_KEY = "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_line_dedup": f"""
        with lines as (
          select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                 unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as place
          from documents
        ), keyed as (select *, {LINE_KEY} as key from lines),
        dropped as (
          select key, max(doc_id) as keeper from keyed where length(key) >= 20
          group by key having count(distinct doc_id) >= 3
        ), marked as (
          select doc_id, place, line, keeper is not null and keeper <> doc_id as gone
          from keyed left join dropped using (key)
        )
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
        from marked group by doc_id
    """,
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op8_decontamination"] = f"""
    with words as (
      select doc_id, regexp_extract_all({LOWERED}, '{WORD}') as w from documents
    ), items as (
      select item_id, regexp_extract_all({LOWERED}, '{WORD}') as w from benchmark
    ), windows as (
      select item_id, least(10, len(w)) as size,
             unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda k: w[k:k + least(10, len(w)) - 1])) as run
      from items where len(w) > 0
    ), runs as (
      select doc_id, size, unnest(range(1, len(w) - size + 2)) as place, w
      from words, (select distinct size from windows) where len(w) >= size
    ), hits as (
      select doc_id, item_id, place, runs.size from runs
      join windows on windows.size = runs.size and windows.run = w[place:place + runs.size - 1]
    ), places as (
      select doc_id, count(distinct p) as n_hit
      from (select doc_id, unnest(range(place, place + size)) as p from hits) group by doc_id
    ), found as (
      select doc_id, count(distinct item_id) as n_items,
             array_to_string(list_sort(list_distinct(list(cast(item_id as varchar)))), ',') as items
      from hits group by doc_id
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from words left join places using (doc_id) left join found using (doc_id)
"""


def _cut(text: str, ends: str, mark: int) -> str:
    """The text's parts, each with its end. They are cut at a mark that is put after
    each end, a character that the tables' texts do not hold."""
    marked = f"regexp_replace({text}, '({ends})', '\\1' || chr({mark}), 'g')"
    return f"string_split(case when ends_with({marked}, chr({mark})) then left({marked}, -1) else {marked} end, chr({mark}))"


def _tree(text: str) -> str:
    """Digests of runs in paragraphs in sections, as nested lists."""
    sentences, paragraphs, sections = _cut("p", "[.!?] ", 1), _cut("s", r"\n", 2), _cut(text, r"\n\n+", 3)
    runs = f"flatten(list_transform({sentences}, lambda t: regexp_extract_all(t, '(?:[^ ]+ *){{1,4}}| +|^$')))"
    return f"""list_transform({sections}, lambda s: list_transform({paragraphs},
               lambda p: list_transform({runs}, lambda x: md5(x))))"""


def _printed(tree: str) -> str:
    sections = (
        f"array_to_string(list_transform({tree}, lambda s: md5('s' || array_to_string(list_transform(s, "
        "lambda p: md5('p' || array_to_string(p, ''))), ''))), '')"
    )
    shorts = (
        f"array_to_string(list_transform({tree}, lambda s: array_to_string(list_transform(s, "
        "lambda p: array_to_string(list_transform(p, lambda x: x[1:8]), '') || '.'), '') || '/'), '')"
    )
    return f"sha256('d' || {sections}) || ':' || {shorts}"


def _likeness(one: str, other: str) -> str:
    a, b = (f"list_distinct(list_transform(flatten(flatten({tree})), lambda s: left(s, 8)))" for tree in (one, other))
    return f"cast(2 * len(list_intersect({a}, {b})) as double) / (len({a}) + len({b}))"


ORACLES["op10_merkle_fingerprint"] = f"""
    with texts as (
      select doc_id, coalesce(text, '') as text,
             coalesce(lead(coalesce(text, '')) over down,
                      first_value(coalesce(text, '')) over down) as following
      from documents window down as (order by doc_id desc)
    ), changed as (
      select *, left(text, length(text) - length(text) // 3) || left(following, length(text) // 3) as edited from texts
    ), trees as (
      select doc_id, length(text) as n_chars, sha256(edited) as edited_sha256,
             {_tree("text")} as own, {_tree("edited")} as new, {_tree("following")} as next
      from changed
    )
    select doc_id, n_chars, edited_sha256, {_printed("own")} as fingerprint, {_printed("new")} as edited_fingerprint,
           {_likeness("own", "new")} as near_edited, {_likeness("own", "next")} as near_next
    from trees
"""
