"""SQL fragments shared by the oracle queries."""

from __future__ import annotations

# The split pattern without look-ahead: a mark (code 1) goes in front of the last
# white space of a run that text follows, so a run stops there.
_SQL_PATTERN = (
    r"''(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,%d}| ?[^\s\p{L}\p{N}\x01]+[\r\n]*|\s*[\r\n]|\s+"
)
N_MERGES = 32
LN2 = "0.6931471805599453"


def draw(parts: str, bound: str | int) -> str:
    """SQL twin of ``draw(seeded_hash(...))``; ``parts`` are the joined hash parts."""
    return f"(('0x' || substr(md5({parts}), 1, 15))::BIGINT % ({bound}))"


def pieces(text: str, digits: int = 3) -> str:
    marked = rf"regexp_replace({text}, '(\s+)(\s\S)', '\1' || chr(1) || '\2', 'g')"
    return f"regexp_extract_all({marked}, '{_SQL_PATTERN % digits}')"


def symbols(text: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(hex(encode({text})), '..'), "
        "lambda h: chr(19968 + ('0x' || h)::INT)), '')"
    )


def train(levels: int = N_MERGES, source: str = "documents", text: str = "text", digits: int = 3, prefix: str = "") -> str:
    """CTEs w0..wN (words), m1..mN (chosen pairs) and ``merges``: one level a merge."""
    p = prefix
    ctes = [
        f"{p}piece_counts AS MATERIALIZED (SELECT piece, count(*) AS cnt FROM "
        f"(SELECT unnest({pieces(text, digits)}) AS piece FROM {source}) GROUP BY piece)",
        f"{p}w0 AS MATERIALIZED (SELECT cnt, {symbols('piece')} AS syms FROM {p}piece_counts)",
    ]
    for i in range(1, levels + 1):
        ctes.append(
            f"{p}m{i} AS MATERIALIZED (SELECT pair AS ab, sum(cnt)::BIGINT AS cnt FROM (SELECT cnt, "
            f"unnest(list_transform(range(1, length(syms)), lambda i: substr(syms, i, 2))) AS pair FROM {p}w{i-1} "
            f"WHERE length(syms) > 1) GROUP BY pair ORDER BY cnt DESC, ab LIMIT 1)"
        )
        ctes.append(
            f"{p}w{i} AS MATERIALIZED (SELECT cnt, replace(syms, (SELECT ab FROM {p}m{i}), "
            f"chr({19968 + 255 + i})) AS syms FROM {p}w{i-1})"
        )
    rows = " UNION ALL ".join(
        f"SELECT {i - 1} AS rank, unicode(ab) - 19968 AS l, unicode(substr(ab, 2, 1)) - 19968 AS r, "
        f"{255 + i} AS token_id, cnt FROM {p}m{i}"
        for i in range(1, levels + 1)
    )
    ctes.append(f"{p}merges AS MATERIALIZED ({rows})")
    return ",\n".join(ctes)


def encoded(text: str, levels: int = N_MERGES, digits: int = 3, prefix: str = "") -> str:
    """Symbol string of a text: pieces kept apart by a separator while rules apply."""
    body = symbols(f"array_to_string({pieces(text, digits)}, chr(30))")
    for i in range(1, levels + 1):
        body = f"replace({body}, (SELECT ab FROM {prefix}m{i}), chr({19968 + 255 + i}))"
    return f"replace({body}, chr({19968 + 30}), '')"


def ids(syms: str) -> str:
    return f"list_transform(string_split({syms}, ''), lambda c: unicode(c) - 19968)"


def joined(ids_list: str) -> str:
    return f"array_to_string({ids_list}, ' ')"


def token_bytes(levels: int = N_MERGES) -> str:
    """CTE ``vocab(token_id, hex)``: bytes of every token, level by level."""
    ctes = [
        "v0 AS MATERIALIZED (SELECT i::INT AS token_id, lpad(to_hex(i), 2, '0') AS hx FROM range(256) t(i))"
    ]
    for i in range(1, levels + 1):
        ctes.append(
            f"v{i} AS MATERIALIZED (SELECT * FROM v{i-1} UNION ALL SELECT {255 + i}, "
            f"(SELECT hx FROM v{i-1}, merges WHERE merges.rank = {i-1} AND v{i-1}.token_id = merges.l) || "
            f"(SELECT hx FROM v{i-1}, merges WHERE merges.rank = {i-1} AND v{i-1}.token_id = merges.r))"
        )
    ctes.append(f"vocab AS MATERIALIZED (SELECT token_id, hx, length(hx) // 2 AS n_bytes FROM v{levels})")
    return ",\n".join(ctes)
