"""Rows of vectors with nulls, ties, repeats, odd widths and clashing names."""

import random

NAMES = "id x asked row_no group block floor score rank times deviation whitened component n value at length key".split()


def rows(seed: int = 4, count: int = 300, width: int = 6) -> list[tuple]:
    draw = random.Random(seed)
    out = []
    for key in range(count):
        size = draw.choice([0.2, 1.0, 5.0])
        out.append((key, [draw.gauss(0, size) for _ in range(width)]))
    hot = [1.5, -2.25, 0.5, 1.0, 0.0, 3.0]
    out += [(1_000 + key, hot) for key in range(150)]
    out += [(0, hot), (0, hot), (50, out[50][1]), (None, hot), (None, [9.0] * width), (7, [3.0, 1.0]), (8, [])]
    out += [(100, None), (200, [1.0, None]), (300, [float("nan")] * width), (350, [float("inf")] + [0.0] * 5)]
    draw.shuffle(out)
    return out


def table(spark, given):
    full = [(*row, *(None if (at + number) % 3 else "own" for number in range(len(NAMES)))) for at, row in enumerate(given)]
    names = ", ".join(f"`{name}` string" for name in NAMES)
    return spark.createDataFrame(full, f"vec_id long, embedding array<double>, {names}").repartition(5)


def whole(given):
    return [
        (key, vector)
        for key, vector in given
        if vector is not None and all(v is not None and abs(v) < float("inf") for v in vector)
    ]
