"""SQL of the repair of column groups and of the choice between two readers, as chains of common table expressions."""

from __future__ import annotations

#: By identity: member, sign, and whether a group has it (SQL).
_SOY, _OTHER, _ANY = "commodity IS NOT DISTINCT FROM 'soybeans'", "commodity IS DISTINCT FROM 'soybeans'", "true"
RULES = {
    "supply": (("beginning_stocks", 1, _ANY), ("production", 1, _ANY), ("imports", 1, _ANY), ("supply_total", -1, _ANY)),
    "use": (("domestic_total", 1, _OTHER), ("crush", 1, _SOY), ("exports", 1, _ANY), ("seed", 1, _SOY), ("residual", 1, _SOY), ("use_total", -1, _ANY)),
    "ending": (("supply_total", 1, _ANY), ("use_total", -1, _ANY), ("ending_stocks", -1, _ANY)),
}
MEMBERS = tuple(dict.fromkeys(m for rule in RULES.values() for m, _, _ in rule))


def _sweep(rule: tuple, source: str, k: int) -> str:
    """Tables s{k}, f{k} and t{k}: an identity's numbers, what fits, and the state after its turn."""
    total = lambda f: " + ".join(f(*m) for m in rule)
    flag = lambda x: f"CAST({x} AS INTEGER)"
    derived = lambda m, sign: f"(coalesce(v_{m}, 0) - off / {sign})"
    numbers = (
        f"{total(lambda m, s, w: flag(w))} AS n, {total(lambda m, s, w: flag(f'({w}) AND v_{m} IS NULL'))} AS holes,"
        f" {total(lambda m, s, w: f'CASE WHEN {w} THEN {s} * coalesce(v_{m}, 0) ELSE 0 END')} AS off"
    )

    def fits(m: str, sign: int, w: str) -> str:
        most = ", ".join(f"CASE WHEN {o_w} THEN abs(v_{o}) END" for o, _, o_w in rule if o != m)
        return f"({w}) AND (holes = 0 OR v_{m} IS NULL) AND {derived(m, sign)} >= 0 AND coalesce({derived(m, sign)} <= 3 * greatest({most}), true) AS f_{m}"

    says = "live AND holes <= 1 AND holes < n AND NOT (holes = 0 AND abs(off) <= 1.6) AS says"
    one = f"says AND {total(lambda m, s, w: flag(f'f_{m}'))} = 1"
    new = ", ".join(
        f"CASE WHEN one AND f_{m} THEN {derived(m, s)} ELSE v_{m} END AS v_{m}, m_{m} OR (one AND f_{m} AND NOT b_{m}) AS m_{m},"
        f" b_{m} OR (says AND NOT one AND ({w}) AND v_{m} IS NOT NULL) AS b_{m}"
        for m, s, w in rule
    )
    drop = f"EXCLUDE (n, holes, off, says, one, {', '.join(f'f_{m}' for m, _, _ in rule)})"
    return f"""s{k} AS (SELECT *, {numbers} FROM {source}
), f{k} AS (SELECT *, {says}, {', '.join(fits(*m) for m in rule)} FROM s{k}
), t{k} AS (SELECT * {drop} REPLACE ({new}) FROM (SELECT *, {one} AS one FROM f{k}))"""


def repair(rows: str, by: list[str]) -> str:
    """A SELECT of ``by``, attribute, value and qa_status of the repaired groups of ``rows`` (``by``, attribute, value)."""
    keys = ", ".join(by)
    first = ", ".join(f"max(value) FILTER (attribute = '{m}') AS v_{m}, coalesce(bool_or(attribute = '{m}'), false) AS h_{m}, false AS m_{m}, false AS b_{m}" for m in MEMBERS)
    count = " + ".join(f"CAST(m_{m} AS INTEGER)" for m in MEMBERS)
    chain, last, k = [f"t0 AS (SELECT {keys}, true AS live, {first} FROM ({rows}) GROUP BY {keys})"], "t0", 0
    for turn in range(3):
        chain.append(f"b{turn} AS (SELECT *, {count} AS before FROM {last})")
        last = f"b{turn}"
        for rule in RULES.values():
            k += 1
            chain.append(_sweep(rule, last, k))
            last = f"t{k}"
        chain.append(f"e{turn} AS (SELECT * EXCLUDE (before) REPLACE (live AND {count} > before AS live) FROM {last})")
        last = f"e{turn}"
    inside = {m: " OR ".join(f"({w})" for rule in RULES.values() for o, _, w in rule if o == m) for m in MEMBERS}
    cells = " UNION ALL ".join(
        f"SELECT {keys}, '{m}' AS attribute, v_{m} AS value, CASE WHEN b_{m} THEN 'quarantined' WHEN m_{m} THEN 'corrected' WHEN {inside[m]} THEN 'ok' ELSE 'warn' END AS qa_status FROM {last} WHERE h_{m} OR v_{m} IS NOT NULL"
        for m in MEMBERS
    )
    others = f"SELECT {keys}, attribute, max(value), 'warn' FROM ({rows}) WHERE attribute NOT IN ({', '.join(repr(m) for m in MEMBERS)}) GROUP BY {keys}, attribute"
    return f"SELECT * FROM (WITH {', '.join(chain)} {cells} UNION ALL {others})"


def arbitration(first: str, second: str, by: list[str]) -> str:
    """A SELECT of ``by``, attribute, value and qa_status of the choice between two readers' rows (``by``, attribute, value)."""
    keys = ", ".join(by)
    one = lambda rows, name: f"(SELECT {keys}, attribute, max(value) AS {name} FROM ({rows}) GROUP BY {keys}, attribute)"
    member = lambda m: f"max(v) FILTER (attribute = '{m}')"
    holds, backed = [], []
    for rule in RULES.values():
        forms = {w for _, _, w in rule} - {_ANY} or {_ANY}
        for form in sorted(forms):
            mine = [(m, s) for m, s, w in rule if w in (form, _ANY)]
            holds.append(f"({form}) IS FALSE OR coalesce(abs({' + '.join(f'{s} * v_{m}' for m, s in mine)}) <= 1.6, true)")
            backed.append(f"(({form}) AND {' AND '.join(f'v_{m} IS NOT NULL' for m, _ in mine)} AND attribute IN ({', '.join(repr(m) for m, _ in mine)}))")
    return f"""SELECT * FROM (WITH p AS (
        SELECT {keys}, attribute, a, b, coalesce(abs(a - b) <= 0.051, false) AS agree FROM {one(first, "a")} FULL JOIN {one(second, "b")} USING ({keys}, attribute) WHERE a IS NOT NULL OR b IS NOT NULL
    ), g AS (SELECT {keys}, dense_rank() OVER (ORDER BY {keys}) AS gid, attribute, a, b, agree, CASE WHEN NOT agree THEN row_number() OVER (PARTITION BY {keys}, agree ORDER BY attribute) - 1 END AS k FROM p
    ), n AS (SELECT gid, count(*) AS n FROM g WHERE NOT agree GROUP BY gid
    ), x AS (SELECT gid, u.x AS choice FROM n, unnest(range(CAST(2 ** n AS BIGINT))) u(x) WHERE n <= 8
    ), t AS (SELECT gid, choice, commodity, attribute, agree, CASE WHEN agree OR (choice >> k) % 2 = 0 THEN a ELSE b END AS v FROM x JOIN g USING (gid)
    ), w AS (
        SELECT gid, choice, commodity, bool_or(NOT agree AND v IS NULL) AS hole, {', '.join(f"{member(m)} AS v_{m}" for m in MEMBERS)} FROM t GROUP BY gid, choice, commodity
    ), won AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY gid) AS winners FROM w WHERE NOT hole AND {' AND '.join(f'({h})' for h in holds)}) WHERE winners = 1
    ), c AS (
        SELECT g.*, CASE WHEN (choice >> k) % 2 = 0 THEN a ELSE b END AS pick, choice IS NOT NULL AND NOT agree AND ({' OR '.join(backed)}) AS backed
        FROM g LEFT JOIN (SELECT * EXCLUDE (commodity) FROM won) USING (gid)
    ) SELECT {keys}, attribute, CASE WHEN agree THEN a WHEN backed THEN pick ELSE coalesce(a, b) END AS value,
        CASE WHEN agree THEN 'ok' WHEN backed THEN CASE WHEN coalesce(abs(a - pick) <= 0.051, false) THEN 'ok' ELSE 'corrected' END
             WHEN a IS NOT NULL AND b IS NOT NULL THEN 'quarantined' ELSE 'warn' END AS qa_status FROM c)"""
