"""DuckDB expressions that the curation queries are held against."""

from __future__ import annotations

import re

from grainmill.functions import fixed
from grainmill.operators import cast

WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: What both sides put into texts that are too tidy to be detokenized.
NOISE = ((". ", " . <newline> "), (", ", " , `` x '' do n't "), (" the ", " ( the ) \n\n\n\n' it 's \" "))
NOISE_HEAD = " [ WP ] "


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {quote(pattern)}, {to}, 'g')"


def noisy(x: str) -> str:
    for old, new in NOISE:
        x = f"replace({x}, {quote(old)}, {quote(new)})"
    return f"({quote(NOISE_HEAD)} || {x})"


def strip(x: str) -> str:
    return _sub(x, rf"\A{WS}+|{WS}+\z", "''")


def clean(x: str) -> str:
    x = f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    return strip(_sub(_sub(x, r"[ \t]+\n", "chr(10)"), r"\n{3,}", "chr(10) || chr(10)"))


def detokenize(x: str) -> str:
    x = f"replace(replace({x}, '``', '\"'), '''''', '\"')"
    for pattern, to in (
        (rf"(?i){WS}*<{WS}*newline{WS}*>{WS}*", "chr(10)"), (rf"\A{WS}*\[{WS}*[A-Z]{{2,3}}{WS}*\]{WS}*", "''"), (rf"{WS}+([,.!?;:%)\]}}])", r"'\1'"), (rf"([(\[{{]){WS}+", r"'\1'"), (rf"{WS}+n't\b", "'n''t'"),
        (rf"{WS}+'(s|re|ve|ll|d|m)\b", r"'''\1'"), (rf'{WS}+"{WS}*', "' \"'"), (r"[ \t]+", "' '"), (r"\n{3,}", "chr(10) || chr(10)"),
    ):
        x = _sub(x, pattern, to)
    return strip(x)


def strip_think(x: str) -> str:
    tail = f"substring({x}, instr({x}, '</think>') + 8)"
    return f"CASE WHEN contains({x}, '</think>') THEN {_sub(tail, rf'\A{WS}+', chr(39) * 2)} ELSE {x} END"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {quote(WS + '+')}), lambda w: w <> '')"


def ttr(x: str) -> str:
    return f"CASE WHEN len({words(x)}) > 0 THEN len(list_distinct(list_transform({words(x)}, lambda w: lower(w)))) / len({words(x)}) ELSE 0 END"


def _share(x: str, pattern: str) -> str:
    return f"CASE WHEN length({x}) > 0 THEN length({_sub(x, pattern, chr(39) * 2)}) / length({x}) ELSE 0 END"


def ascii_ratio(x: str) -> str:
    return _share(x, r"[^\x00-\x7F]+")


def alpha_ratio(x: str) -> str:
    return _share(x, r"[^\p{L}]+")


def reason(x: str, min_len: int = 120, max_len: int = 12000) -> str:
    return (
        f"CASE WHEN length({x}) = 0 THEN 'empty' WHEN length({x}) < {min_len} THEN 'short' WHEN length({x}) > {max_len} THEN 'long' WHEN {ascii_ratio(x)} < 0.85::DOUBLE THEN 'ascii' "
        f"WHEN {alpha_ratio(x)} < 0.5::DOUBLE THEN 'alpha' WHEN len({words(x)}) < 20 THEN 'words' WHEN {ttr(x)} < 0.28::DOUBLE THEN 'repetition' END"
    )


def is_sfw(*xs: str) -> str:
    joined = " || chr(10) || ".join(xs)
    return f"NOT regexp_matches(lower({joined}), '{'|'.join(map(re.escape, fixed.BLOCKED_TERMS))}')"


def hits(x: str, patterns: tuple[str, ...]) -> str:
    """Words of letters, marks, digits and low lines are matched whole; ``\\w`` of the patterns is Unicode's."""
    word = r"[\p{L}\p{M}\p{N}_]"
    body = "|".join(p.replace(r"\w", word) for p in patterns)
    return f"len(list_filter(regexp_extract_all({x}, '{word}+'), lambda w: regexp_full_match(lower(w), '{body}')))"


def key(x: str) -> str:
    return f"md5(left(trim({_sub(f'lower({x})', WS + '+', quote(' '))}), 500))"


KEYED = f"WITH keyed AS (SELECT doc_id, lang, {key('text')} AS key FROM documents)"


def fold(langs: list[str], limit: int) -> str:
    """Slices in turn: new keys, first of each, cap."""
    steps, seen = [], []
    for k, x in enumerate(langs):
        fresh = f"SELECT * FROM keyed WHERE lang = '{x}'" + "".join(f" AND key NOT IN (SELECT key FROM s{j})" for j in seen)
        steps.append(f"s{k} AS (SELECT * FROM ({fresh} QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id) = 1) QUALIFY row_number() OVER (ORDER BY doc_id) <= {limit})")
        seen.append(k)
    return f"{KEYED}, {', '.join(steps)} " + " UNION ALL ".join(f"SELECT doc_id, lang, key FROM s{k}" for k in seen)


def build(prompts: dict[str, str], seed: int) -> str:
    system = "CASE lang " + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in prompts.items()) + " END"
    return f"""WITH cleaned AS (SELECT doc_id, lang, source, {clean('text')} AS assistant FROM documents),
        good AS (SELECT * FROM cleaned WHERE {reason('assistant')} IS NULL AND {is_sfw('assistant')}),
        firsts AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY {key('assistant')} ORDER BY lang, doc_id) = 1),
        shaped AS (SELECT *, {system} AS system, 'Continue: ' || left(assistant, 40) AS question, CASE WHEN source <> 'src3' THEN source END AS license FROM firsts),
        placed AS (SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || doc_id), doc_id::VARCHAR) - 1 AS place, count(*) OVER () AS total FROM shaped),
        built AS (SELECT *, length(system) + length(question) + length(assistant) AS n_chars,
            CASE WHEN place < (CASE WHEN total > 20 THEN greatest(1, floor(total * (1 - 0.98::DOUBLE))::BIGINT) ELSE 0 END) THEN 'val' ELSE 'train' END AS split FROM placed)"""


EXCHANGE = "WITH pairs AS (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS u, arg_min(text, turn) FILTER (role = 'assistant') AS a, arg_min(role, turn) AS opener FROM conversations GROUP BY conv_id)"
DIALOGUE = f"""WITH said AS (SELECT conv_id, turn, role, {clean('text')} AS t FROM conversations),
    talks AS (SELECT conv_id, count(*) AS n, string_agg(role || ': ' || t, chr(10) ORDER BY turn) FILTER (t <> '') AS dialogue FROM said GROUP BY conv_id)"""
SCREENPLAY = f"""{EXCHANGE}, shaped AS (
        SELECT conv_id AS pos, {clean('u')} AS "user", {clean('a')} AS assistant, CASE WHEN opener = 'system' THEN 'monologue' ELSE 'tv_pilot' END AS category FROM pairs WHERE u <> '' AND a <> ''),
    named AS (SELECT *, CASE WHEN category = 'monologue' THEN 'screenplay_voice' ELSE 'screenplay_structure' END AS slice FROM shaped WHERE {reason('assistant', max_len=9000)} IS NULL AND {is_sfw('"user"', 'assistant')})
    SELECT pos, slice, "user", assistant, category FROM named QUALIFY row_number() OVER (PARTITION BY slice ORDER BY pos) <= (CASE WHEN slice = 'screenplay_voice' THEN 50 ELSE 100 END)"""
MULTICHAR = f"""{DIALOGUE}, shaped AS (
        SELECT conv_id AS pos, {quote(fixed.SCENE_PROMPT)} || chr(10) || 'Setting: Room ' || conv_id || chr(10) || 'Characters: user, assistant' AS "user", coalesce(dialogue, '') AS assistant FROM talks WHERE n >= 3)
    SELECT pos, "user", assistant FROM shaped WHERE {reason('assistant', max_len=9000)} IS NULL AND {is_sfw('"user"', 'assistant')}"""


def packed(x: str, where: str = "TRUE", separator: str = "chr(10)") -> str:
    """Chunks of at least 1,200 characters; ``x`` is cut into paragraphs at the separator."""
    return f"""WITH RECURSIVE parts AS (
        SELECT doc_id, list_filter(list_transform(string_split({x}, {separator}), lambda p: {strip('p')}), lambda p: p <> '') AS ps FROM documents WHERE {where}),
    walk AS (
        SELECT doc_id, ps, 1 AS k, length(ps[1]) AS n, 0 AS i FROM parts WHERE len(ps) > 0
        UNION ALL
        SELECT doc_id, ps, k + 1, CASE WHEN n >= 1200 THEN length(ps[k + 1]) ELSE n + length(ps[k + 1]) END, CASE WHEN n >= 1200 THEN i + 1 ELSE i END FROM walk WHERE k < len(ps)),
    chunks AS (SELECT doc_id, i, string_agg(ps[k], chr(10) || chr(10) ORDER BY k) AS chunk FROM walk GROUP BY doc_id, i HAVING max(n) >= 1200)"""


def gutenberg(patterns: tuple[str, ...]) -> str:
    doubled = "replace(text, chr(10), chr(10) || chr(10))"
    return f"""{packed(doubled, f'length({doubled}) >= 4000', "chr(10) || chr(10)")},
    cleaned AS (SELECT doc_id, i, {clean('chunk')} AS c FROM chunks),
    good AS (SELECT * FROM cleaned WHERE {reason('c', max_len=4000)} IS NULL AND {hits('c', patterns)} >= 2 AND {is_sfw('c')}),
    four AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) <= 4)
    SELECT doc_id AS pos, doc_id::VARCHAR AS book_id, c AS assistant FROM four QUALIFY row_number() OVER (ORDER BY doc_id, i) <= 500"""


def _row(i: int, *values: str | None) -> str:
    return f"({i}, " + ", ".join("NULL" if v is None else quote(v) for v in values) + ")"


#: An invented character table and a cast from it.
BIBLE = ", ".join(
    [
        _row(0, "Pear", "P", "Male-dominant", 'the "quiet" one', "sage", "calm", "steady", "lies by silence", "green", "seed", "bloom", "turn", "rot"),
        _row(1, "Plum", "Q", "Female-dominant", "the bold one", "rebel", "loud", "brave", "leaves first", "red", "bud", "blaze", "fade", "dust"),
        _row(2, "Fig", "F", "Balanced", "the odd one", "clown", "odd", "warm", "forgets", "brown", "knot", "sweet", "split", "dry"),
    ]
)
SELECTION = ", ".join([_row(0, "Fig", None, None, "Chef", None, None, None), _row(1, "Pear", "Female", "senescence", None, "Jealous", "The Mentor", "owes money"), _row(2, "Kiwi", None, None, None, None, None, None)])

_STAGE = "CASE stage " + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in fixed.STAGES) + " END"
CAST = f"""WITH picked AS (
    SELECT s.pos, b.name, b.emoji, b.example, b.archetype, b.personality, b."character" AS charac, b.cheating, coalesce(s.gender, CASE WHEN b.gender = 'Male-dominant' THEN 'Male' ELSE 'Female' END) AS gender,
        coalesce(s.stage, 'prime') AS stage, coalesce(s.role, '') AS role, coalesce(s.disp, '') AS disp, coalesce(s."char", '') AS chr, coalesce(s.note, '') AS note,
        CASE coalesce(s.stage, 'prime') WHEN 'growth' THEN growth WHEN 'prime' THEN prime WHEN 'ripening' THEN ripening ELSE senescence END AS persona,
        {_STAGE.replace('CASE stage', "CASE coalesce(s.stage, 'prime')")} || ': ' || persona || ' · Cheats: ' || cheating AS trait
    FROM (VALUES {SELECTION}) AS s(pos, name, gender, stage, role, disp, "char", note)
    JOIN (VALUES {BIBLE}) AS b(pos, {', '.join(f'"{c}"' for c in cast.COLUMNS)}) USING (name))"""
ASSEMBLY = f"""{CAST}, entries AS (
        SELECT row_number() OVER (ORDER BY pos) AS i, row_number() OVER (ORDER BY pos) || '. ' || emoji || ' ' || name || ' ("' || example || '") — ' || gender || ', ' || {_STAGE} || '.' || chr(10)
            || '   Stage persona: ' || persona || chr(10) || '   Personality: ' || personality || ' Character: ' || charac || chr(10) || '   Cheating/betrayal pattern: ' || cheating || chr(10)
            || '   Role: ' || CASE WHEN role <> '' THEN role ELSE '{cast.CHOICE}' END || ' · Disposition: ' || CASE WHEN disp <> '' THEN disp ELSE '{cast.CHOICE}' END
            || ' · Dramatic function: ' || CASE WHEN chr <> '' THEN chr ELSE archetype END || CASE WHEN note <> '' THEN chr(10) || '   Note: ' || note ELSE '' END AS entry
        FROM picked),
    told AS (SELECT count(*) AS n_cast, {quote(cast.OPENING.replace('{episode}', '3').replace('{tone}', 'dark'))} || string_agg(entry, chr(10) ORDER BY i) || {quote(f'''

CONTEXT / LOCATION / SETTING:
{cast.NO_CONTEXT}

{cast.CLOSING}''')} AS u FROM entries)
    SELECT n_cast, u AS "user", to_json({{'messages': [{{'role': 'system', 'content': 'Be brief.'}}, {{'role': 'user', 'content': u}}]}})::VARCHAR AS json FROM told"""


def zip_longest(lists: dict[str, tuple[str, ...]]) -> str:
    longest = max(map(len, lists.values()))
    shown = ", ".join(f"coalesce([{', '.join(map(quote, v))}][n], '') AS \"{k}\"" for k, v in lists.items())
    return f"SELECT n::INTEGER AS n, {shown} FROM range(1, {longest + 1}) AS r(n)"


_TURN = "'<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10)"
RENDERED = f"""WITH numbered AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    rendered AS (SELECT conv_id, string_agg({_TURN}, '' ORDER BY turn) AS whole, coalesce(string_agg({_TURN}, '' ORDER BY turn) FILTER (k < n), '') || '<|assistant|>' || chr(10) AS prompt FROM numbered GROUP BY conv_id)"""


def _ids(x: str) -> str:
    return f"list_transform(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> ''), lambda w: ('0x' || left(md5(w), 7))::BIGINT % 50000)"


#: Tokens that a training row is cut to.
MAX_LEN = 2048
MASKED = f"""{RENDERED}, tokens AS (SELECT conv_id, {_ids('whole')} AS f, len({_ids('prompt')}) AS p FROM rendered),
    masked AS (SELECT conv_id, f[1:{MAX_LEN}] AS ids, (list_transform(f, lambda x, i: CASE WHEN i <= p THEN -100 ELSE x END))[1:{MAX_LEN}] AS labels, list_transform(f[1:{MAX_LEN}], lambda x: 1) AS ones FROM tokens WHERE len(list_filter((list_transform(f, lambda x, i: CASE WHEN i <= p THEN -100 ELSE x END))[1:{MAX_LEN}], lambda x: x <> -100)) > 0)"""


def padding(value: str) -> str:
    return f"list_transform(range(n - len(ids)), lambda x: {value})"


JSON_LINES = """(0, '{"a": "x"}'), (1, '{"a": '), (2, 'oops'), (3, '{"a": "y", "b": [1, 2]}'), (4, '{"b": 1}'), (5, '')"""
JSON_LISTS = """(0, '[{"from": "A"}, {"from": "B"}]'), (1, '{"from": "A"}'), (2, 'oops'), (3, '[]'), (4, '7'), (5, '["x", 1, null]'), (6, '{"a": 1, "b": 2}')"""
