"""SQL twins of the resampling, formatting and manifest queries; the level by level parts are written from a rule."""

from __future__ import annotations

#: A column `step`: the 256 values of the checksum's byte table, from its polynomial.
CRC_TABLE = """
select list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as step"""


def crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes; `step` is in scope."""
    byte = f"(16 * (instr('0123456789ABCDEF', hex({text})[2 * j + 1]) - 1) + instr('0123456789ABCDEF', hex({text})[2 * j + 2]) - 1)::bigint"
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen({text})), lambda j: {byte})), "
            f"lambda a, b: xor(a >> 8, step[xor(a & 255, b) + 1])), 4294967295::bigint)")


def lowered(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_WORDS = r"regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')" % lowered("coalesce(text, '')")

RESAMPLING = f"""
with crc as ({CRC_TABLE}),
docs as (select row_number() over () as nr, doc_id, {_WORDS} as words from documents),
doc_words as (select nr, unnest(words) as word from docs),
bench_words as (select unnest({_WORDS}) as word from benchmark),
buckets as (select word, {crc32('word')} % 10000 as bucket
            from (select word from doc_words union select word from bench_words), crc),
have as (select bucket, count(*) as n from doc_words join buckets using (word) group by bucket),
want as (select bucket, count(*) as n from bench_words join buckets using (word) group by bucket),
gain as (select bucket, floor(1000 * ln(((coalesce(want.n, 0) + 1) * (coalesce((select sum(n) from have), 0) + 10000))::double
                / ((have.n + 1) * (coalesce((select sum(n) from want), 0) + 10000))::double))::bigint as gain
         from have left join want using (bucket)),
weights as (select nr, floor(sum(gain) / count(*))::bigint as weight
            from doc_words join buckets using (word) join gain using (bucket) group by nr),
scored as (select nr, doc_id, len(words)::bigint as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
             (('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
           from docs left join weights using (nr)),
ranked as (select nr, row_number() over (order by score desc, doc_id nulls last, n_features, weight) as place, count(*) over () as n
           from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= n * 10 // 100 then place end as rank
from scored left join ranked using (nr)"""

_ESCAPED = r"regexp_replace(coalesce(%s, ''), '([<\[])(\\*)(INST\]|/INST\]|s>|/s>|<SYS>>|</SYS>>|unk>|pad>)', '\1\\\2\3', 'g')"

FORMATTING = f"""
with turns as (
  select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
plain as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from turns)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length('[INST]' || {_ESCAPED % 'role'} || '[/INST]' || {_ESCAPED % 'text'} || '</s>'))::bigint as formatted_chars
from plain group by conv_id"""


def _tree(prefix: str, leaves: str, levels: int) -> list[str]:
    """CTEs of the levels of trees: nodes with their tree's size, runs of sixteen as lists, and the tops."""
    out = [f"{prefix}0 as ({leaves})"]
    for i in range(levels):
        out.append(f"{prefix}run{i} as (select tree, index // 16 as up, list(hash order by index) as run, any_value(n) as n "
                   f"from {prefix}{i} where n > 1 group by tree, index // 16)")
        out.append(f"{prefix}{i + 1} as (select tree, up as index, sha256(array_to_string(run, '')) as hash, (n + 15) // 16 as n from {prefix}run{i})")
    tops = " union all ".join(f"select tree, hash from {prefix}{i} where n = 1" for i in range(levels + 1))
    return [*out, f"{prefix}top as ({tops})"]


def _walk(prefix: str, start: str, index: str, levels: int) -> list[str]:
    """CTEs that take every row of `start` (tree, proof, folded, ...) up the levels by the place `index`."""
    out, before = [], start
    for i in range(levels):
        place = f"({index} // {16 ** i})"
        slot = f"({place} % 16)"
        others = f"array_to_string(list_concat(run[:{slot}], run[{slot} + 2:]), '')"
        folded = f"sha256(array_to_string(run[:{slot}], '') || folded || array_to_string(run[{slot} + 2:], ''))"
        out.append(f"{prefix}walk{i} as (select w.* replace (case when run is null then proof else proof || {others} end as proof, "
                   f"case when run is null then folded else {folded} end as folded) "
                   f"from {before} w left join {prefix}run{i} r on r.tree = w.{prefix}tree and r.up = {place} // 16)")
        before = f"{prefix}walk{i}"
    return out


def manifest(levels: int = 6) -> str:
    """The manifest by trees of up to 16 ** levels leaves."""
    def framed(value: str) -> str:
        return f"coalesce(strlen({value}::varchar) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    ctes = [
        f"crc as ({CRC_TABLE})",
        f"docs as (select doc_id, source, {leaf('text')} as leaf, case when coalesce({crc32('doc_id::varchar')}, 1) % 5 = 0 "
        f"then {leaf(lowered('text'))} else {leaf('text')} end as folded from documents, crc)",
        "placed as (select *, dense_rank() over (order by source is not null, encode(source)) - 1 as atree, "
        "row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by source) as n from docs)",
        *_tree("a", "select atree as tree, place as index, leaf as hash, n from placed", levels),
        *_tree("b", "select 0 as tree, tree as index, hash, (select count(*) from atop) as n from atop", levels),
        "start as (select doc_id, leaf, atree, 0 as btree, place, '' as proof, folded from placed)",
        *_walk("a", "start", "w.place", levels),
        *_walk("b", f"awalk{levels - 1}", "w.atree", levels),
    ]
    return ("with " + ",\n".join(ctes) + f"\nselect doc_id, leaf, atop.hash as subroot, btop.hash as root, sha256(proof) as proof_sha256, "
            f"folded as folded_root, folded = btop.hash as verified\nfrom bwalk{levels - 1} w join atop on atop.tree = w.atree, btop")


MANIFEST = manifest()
