"""Linking against a plain loop over small conversations."""

import random
import re

from cumulus.llm import quotation as Q
from tests.llm.conftest import prose

SCHEMA = "conv_id long, turn long, role string, text string"


def norm(t):
    return re.sub(r"\s+", " ", t).strip(" ").lower()


def passages(text):
    out = []
    for line in text.split("\n"):
        p = re.match(r"[ \t]*(?:>[ \t]*)*", line).group()
        d = p.count(">")
        c = line[len(p):] if d else line
        if out and out[-1][0] == d:
            out[-1][1].append(c)
        else:
            out.append((d, [c]))
    return [(d, "\n".join(cs)) for d, cs in out]


def units(t):
    got = [(3, norm(t)), *((2, norm(x)) for x in re.split(r"\n[ \t]*\n", t)), *((1, norm(x)) for x in t.split("\n"))]
    return [u for u in got if u[1]]


def plain(rows):
    msgs = [(c, t, r, x or "") for c, t, r, x in rows]
    parent, out = {}, []
    own = []  # (unit, level, conv, turn, index)
    for i, (c, t, _, x) in enumerate(msgs):
        if c is not None and t is not None:
            own += [(u, lv, c, t, i) for d, p in passages(x) if d == 0 for lv, u in units(p)]
    info = {}
    for i, (c, t, _, x) in enumerate(msgs):
        quotes = [(k, d, p) for k, (d, p) in enumerate(passages(x)) if d]
        linked, reply = 0, None
        for k, d, p in quotes:
            best = None
            if c is not None and t is not None:
                for lv, u in units(p):
                    here = [(tt, ii) for uu, _, cc, tt, ii in own if uu == u and cc == c]
                    there = [(cc, tt, ii) for uu, l2, cc, tt, ii in own if uu == u and l2 > 1]
                    if here and min(here)[0] < t:
                        cand = (-lv, False, -min(here)[0], (c, *min(here)))
                    elif lv > 1 and there and min(there)[0] < c:
                        cand = (-lv, True, -min(there)[1], min(there))
                    else:
                        continue
                    best = min(best, cand) if best else cand
            if best:
                linked += 1
                if d == 1 and reply is None:
                    reply = best[3]
        info[i] = (len(quotes), linked, reply)
        if reply:
            parent[i] = reply[2]
    for i, (c, t, r, x) in enumerate(msgs):
        root, hops = i, 0
        while root in parent:
            root, hops = parent[root], hops + 1
        text = "\n".join(cs for d, p in passages(x) if d == 0 for cs in p.split("\n")).strip(" \t\r\n")
        n, linked, reply = info[i]
        out.append((c, t, r, text, n, linked, reply and reply[0], reply and reply[1], msgs[root][0], msgs[root][1], hops))
    return sorted(out, key=repr)


def messages(seed):
    rng, rows = random.Random(seed), []
    for c in range(6):
        texts = []
        for t in range(8):
            body = [prose(rng, rng.randint(2, 8)) for _ in range(rng.randint(1, 3))]
            quoted = []
            if texts and rng.random() < .7:
                src = rng.choice(texts).split("\n")
                k = rng.randrange(len(src))
                quoted = [rng.choice([">", "> "]) + x for x in (src if rng.random() < .5 else src[k:k + 1])]
            if rows and rng.random() < .2:
                quoted += ["> " + x.upper() for x in rng.choice(rows)[3].split("\n")]
            texts.append("\n".join(rng.choice([quoted + body, quoted + [""] + body])))
            rows.append((c, t, rng.choice(["user", "assistant"]), texts[-1]))
    return rows


def test_matches_plain_form(spark):
    for seed in (1, 2):
        rows = messages(seed)
        out = Q.linked(spark.createDataFrame(rows, SCHEMA)).collect()
        assert sorted((tuple(r)[:11] for r in out), key=repr) == plain(rows)
        assert any(r["hops"] > 1 for r in out)
        of = {}
        for r in sorted(out, key=lambda r: (r["thread_conv_id"], r["position"])):
            of.setdefault(r["thread_conv_id"], []).append(r)
        for rs in of.values():
            assert [r["position"] for r in rs] == list(range(len(rs)))
            keys = [(r["thread_turn"], r["hops"] > 0, r["conv_id"], r["turn"]) for r in rs]
            assert keys == sorted(keys)


def test_edges(spark):
    rows = [(1, 0, "u", "Hello"), (1, 0, "u", "Hello"), (1, 1, None, "> hello\n> \nhi"), (1, None, "u", "> hello"),
            (None, 1, "u", "> hello"), (2, 0, "a", None), (2, 1, "a", ""), (2, 2, "a", ">"), (2, 3, "a", ">>> deep\nx"),
            (2, 4, "a", "> x " * 3), (3, 0, "u", "w " * 20_000)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("mid", "h", "to", "lines", "root")})
    out = Q.linked(df).collect()
    assert sorted((tuple(r)[:11] for r in out), key=repr) == plain(rows)
    assert Q.linked(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = Q.linked(spark.createDataFrame(messages(1), SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_oracle_on_quoting_messages(spark):
    import duckdb
    import pandas as pd
    rows = messages(3)
    duck = duckdb.connect()
    duck.register("frame", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    duck.execute("CREATE TABLE conversations AS SELECT * FROM frame")
    rel = duck.sql(Q.ORACLE)
    out = Q.linked(spark.createDataFrame(rows, SCHEMA))
    want = sorted((tuple(r[rel.columns.index(c)] for c in out.columns) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
