import hashlib
from collections import defaultdict

from ferry.llm import lines
from messy import LOWER, SPACE


def lines_kept(rows):
    """Text of each row after brute-force line dedup, in the order of ``rows``."""
    return ["\n".join(stay) for _, _, stay in _sifted(rows, 40, 5)]


def _sifted(rows, min_chars, min_docs):
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACE).translate(LOWER)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text, *_ in rows:
        all_lines = (text or "").split("\n")
        stay = [x for x in all_lines
                if doc is None or len(holders[key(x)]) < min_docs or doc == max(holders[key(x)])]
        out.append((doc, len(all_lines), stay))
    return out


def brute(rows, min_chars=40, min_docs=5):
    return sorted(((doc, n, n - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest())
                   for doc, n, stay in _sifted(rows, min_chars, min_docs)), key=str)


def test_against_brute_force(messy, rows):
    got = sorted(map(tuple, lines.digest(messy).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 20


def test_keeps_other_columns_and_empty_table(messy, no_docs):
    out = lines.dedup_lines(messy)
    assert out.columns == [*messy.columns, "_n_lines", "_n_dropped"]
    assert {r.h for r in out.select("h").collect()} == {"clash h"}
    assert lines.digest(no_docs).collect() == []


def test_plan_is_native(messy):
    plan = lines.digest(messy)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "MapInArrow"))
