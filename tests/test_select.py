"""Preset walk and choice: golden cases and a check against a plain loop."""

import random

from loomkit.operators import select as S


def loop_choice(cands, budget, min_c=2):
    """Plain-Python model: walk presets in order, stop early, best score, fallback last."""
    picked = []
    for idx, size, score in sorted(cands):
        if size <= budget:
            picked.append((score if score is not None else 0.0, size, idx))
            if len(picked) >= min_c and size < budget * 0.5:
                break
    if not picked:
        idx, size, score = sorted(cands)[-1]
        return idx, True
    best = picked[0]
    for c in picked[1:]:
        if c[0] > best[0]:
            best = c
    return best[2], False


def frame(spark, rows):
    return spark.createDataFrame(rows, "image_id long, idx int, size long, score double")


def test_golden(spark):
    df = frame(spark, [(1, 0, 900, 0.1), (1, 1, 400, 0.2), (1, 2, 300, 0.9), (1, 3, 100, 0.9),
                       (2, 0, 2000, 0.5), (2, 1, 1500, 0.9),
                       (3, 0, 100, 0.5), (3, 1, 100, 0.5)])
    walked = {(r.image_id, r.idx) for r in S.mark_walk(df, 1000).where("considered AND fits").collect()}
    assert {i for (img, i) in walked if img == 1} == {0, 1}
    ch = {r.image_id: (r.idx, r.fallback) for r in S.choose(df, 1000, with_svg=False).collect()}
    assert ch == {1: (1, False), 2: (1, True), 3: (0, False)}


def test_matches_loop(spark):
    random.seed(3)
    rows, grids = [], {}
    for img in range(300):
        n = random.randint(1, 16)
        grid = [(i, random.choice([random.randint(0, 6000), random.randint(0, 2000)]),
                 random.choice([None, round(random.random(), 2), 0.5])) for i in range(n)]
        grids[img] = grid
        rows += [(img, i, s, sc) for i, s, sc in grid]
    got = {r.image_id: (r.idx, r.fallback) for r in S.choose(frame(spark, rows), 5120, with_svg=False).collect()}
    assert got == {img: loop_choice(g, 5120) for img, g in grids.items()}


def test_presets_and_grid(spark):
    assert len(S.preset_rows(True)) == 13 and len(S.preset_rows(False)) == 16
    assert S.preset_rows(True)[0][3:5] == (8, 4)
    imgs = spark.createDataFrame([(1,), (2,)], "image_id long")
    g = S.with_presets(imgs, posterize=True)
    assert g.count() == 26 and "Exchange" not in g._jdf.queryExecution().executedPlan().toString()
