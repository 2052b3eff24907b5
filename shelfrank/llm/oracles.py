"""SQL for the queries whose results SQL can state, independent of how they are found."""

from __future__ import annotations

from shelfrank.llm.decontamination import LEAST_SCORE, LEAST_SHARE, MASKS, SHORT_ITEM, SHORT_MASKS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Sets by exact shingles, links by counting what sets share, components by the smallest id
# that spreads over links.
NEAR_DUPLICATES = rf"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[k:k + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as k
        from words)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select x.doc_id as a, y.doc_id as b
  from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id
  having 100 * count(*) >= 75 * (
    (select n from sizes where doc_id = x.doc_id) + (select n from sizes where doc_id = y.doc_id)
    - count(*))),
reached as (
  select doc_id as a, doc_id as b from documents
  union
  select reached.a, links.b from reached join links on reached.b = links.a),
components as (select a, min(b) as component_id from reached group by a)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from documents join components on a = doc_id left join sizes using (doc_id)
"""


def _seeds(side: str, key: str, mask: str, fits: str) -> str:
    picked = ", ".join(f"w[pos + {k}]" for k, mark in enumerate(mask) if mark == "1")
    return f"""
  select {key}, '{mask}' as mask, pos, concat_ws(' ', {picked}) as seed
  from (select {key}, w, unnest(range(1, len(w) - {len(mask)} + 2)) as pos from {side}
        where len(w) >= {len(mask)} and {fits})"""


def _all_seeds(side: str, key: str, size: str) -> str:
    """Windows of all masks; `size` states which items a mask reads, with gaps for the bounds."""
    parts = [_seeds(side, key, mask, size.format(SHORT_ITEM[1] + 1, 1 << 31)) for mask in MASKS]
    parts += [_seeds(side, key, mask, size.format(*sizes)) for mask, sizes in SHORT_MASKS.items()]
    return "\n  union all ".join(parts)


_WORDS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

# The best stretch is the largest rise of the running sum of +1 and -1 along an overlap.
LEAKS = f"""
with texts as (select doc_id, {_WORDS} as w from documents),
items as (
  select item_id, w, least({LEAST_SCORE}, cast(ceil(len(w) * {LEAST_SHARE}) as bigint)) as needed
  from (select item_id, {_WORDS} as w from benchmark)),
doc_seeds as ({_all_seeds("texts", "doc_id", "true")}),
item_seeds as ({_all_seeds("items", "item_id", "len(w) between {} and {}")}),
laid as (
  select distinct doc_id, item_id, d.pos - i.pos as shift
  from doc_seeds d join item_seeds i using (mask, seed)),
compared as (
  select doc_id, item_id, shift, needed, k,
         case when i.w[k] = t.w[k + shift] then 1 else -1 end as step
  from (select *, unnest(range(1, len(w) + 1)) as k from laid join items using (item_id)) i
  join texts t using (doc_id)
  where k + shift between 1 and len(t.w)),
running as (
  select *, sum(step) over (partition by doc_id, item_id, shift order by k) as total
  from compared),
risen as (
  select *, total - least(0, coalesce(min(total) over (
    partition by doc_id, item_id, shift order by k rows between unbounded preceding and 1 preceding
  ), 0)) as score
  from running)
select doc_id, item_id, cast(max(score) as integer) as score
from risen where score >= needed group by doc_id, item_id
"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(digits: str) -> str:
    """Base 32 of hexadecimal digits, five bits pos a time out of two digits."""
    parts = []
    for k in range(32):
        digit, bit = divmod(5 * k, 4)
        pair = f"substr({digits}, {digit + 1}, 2)"
        value = f"((cast('0x' || {pair} as integer) >> {3 - bit}) & 31)"
        parts.append(f"substr('{_LETTERS}', cast({value} as integer) + 1, 1)")
    return " || ".join(parts)


ARCHIVES = f"""
with payloads as (
  select page_id, sha1(coalesce(html, '')) as digits, strlen(coalesce(html, '')) as payload_bytes
  from pages),
firsts as (select *, max(page_id) over (partition by digits) as first from payloads)
select page_id, payload_bytes, {_base32("digits")} as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from firsts
"""

EXACT = r"""
with texts as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body from documents)
select doc_id, first_value(doc_id) over same as keep_id, count(*) over (partition by body) as group_size,
       doc_id = first_value(doc_id) over same as kept, sha256(body) as text_sha256
from texts window same as (partition by body order by points desc, doc_id)
"""

ORACLES = {
    "op5_minhash_lsh_forest": NEAR_DUPLICATES,
    "op7_spaced_seeds": LEAKS,
    "op10_revisit_archives": ARCHIVES,
    "op11_fuse_filter_dedup": EXACT,
}
