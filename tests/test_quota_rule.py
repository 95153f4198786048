"""The daily quota's verdicts against a replay row by row, from any state."""

from __future__ import annotations

import random

import pandas as pd

from verdant.functions import scalars as S
from verdant.streaming.jobs import quota_verdicts


def replay(rows, service, count, last):
    out = []
    for pre, post, pic in rows:
        pic = None if pic is None else pic.value // 1000
        code = pre
        if code is None and service == 1 and count == 1 and last == pic:
            code = "ImgDuplicated"
        elif code is None and count >= S.DAILY_CAP[service]:
            code = "OverCount"
        code = code or post
        if code is None:
            code, count, last = "", count + 1, pic
        out.append(code)
    return out, count, last


def test_verdicts_equal_a_replay():
    rnd = random.Random(4)
    pics = [None, *(pd.Timestamp("2024-01-02 03:04:05.000006") + pd.Timedelta(seconds=i) for i in range(3))]
    for _ in range(2_000):
        rows = [(rnd.choice([None, None, None, "ImgOverSize"]), rnd.choice([None, None, "ModelError"]), rnd.choice(pics))
                for _ in range(rnd.randrange(1, 25))]
        service, count = rnd.choice(sorted(S.DAILY_CAP)), rnd.randrange(0, 4)
        last = rnd.choice([None, pics[1].value // 1000]) if count else None
        frame = pd.DataFrame({"pre_code": [r[0] for r in rows], "post_code": [r[1] for r in rows],
                              "pic_time": pd.Series([r[2] for r in rows], dtype="datetime64[us]")})
        got, n, at = quota_verdicts(frame, service, count, last)
        assert (list(got), n, at) == replay(rows, service, count, last)


def test_a_busy_day_is_decided_in_few_steps():
    n = 400_000
    frame = pd.DataFrame({"pre_code": [None] * n, "post_code": [None] * n, "pic_time": pd.Series(range(n), dtype="datetime64[us]")})
    got, count, _ = quota_verdicts(frame, 1, 0, None)
    assert count == S.DAILY_CAP[1] and (got == "OverCount").sum() == n - count
