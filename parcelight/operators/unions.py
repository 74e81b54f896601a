"""Areas of unions of boxes dilated with round corners, many at once."""

from __future__ import annotations

import math

import numpy as np

from parcelight.functions.polygons import _ragged

#: Boxes of a part that is integrated; a part with more is cut into four, down to sides of LEAST metres.
FEW, LEAST = 8, 0.5
#: Numbers that are worked on at once.
CHUNK = 1 << 20


def _strips(boxes: np.ndarray, clip: np.ndarray, d: float, steps: int) -> np.ndarray:
    """Areas of the unions of boxes (parts, n, 4), dilated by d, within clips (parts, 4).

    Integrates the covered length over y, by Gauss-Legendre rules between the
    heights at which an edge or corner begins or a corner leaves the clip.
    """
    x0, y0, x1, y1 = (boxes[:, :, k] for k in range(4))
    cx0, cy0, cx1, cy1 = (clip[:, k, None] for k in range(4))
    heights = [cy0, cy1, y0 - d, y0, y1, y1 + d] if d else [cy0, cy1, y0, y1]
    if d:
        for c in (cx0, cx1):
            off = np.maximum(np.maximum(x0 - c, c - x1), 0.0)
            rise = np.sqrt(np.maximum(d * d - off * off, 0.0))
            heights += [y0 - rise, y1 + rise]
    ys = np.sort(np.clip(np.concatenate(heights, 1), cy0, cy1), 1)
    low, high = ys[:, :-1], ys[:, 1:]
    nodes, weights = np.polynomial.legendre.leggauss(steps if d else 1)
    angle = (nodes + 1) * np.pi / 2
    weights = weights * np.sin(angle)
    weights /= weights.sum()
    part, strip = np.nonzero(high > low)
    low, high = low[part, strip, None], high[part, strip, None]
    at = (low + (high - low) * (1 - np.cos(angle)) / 2)[:, None, :]  # dense where arcs begin
    side = lambda v: v[part][:, :, None]
    off = np.maximum(np.maximum(side(y0) - at, at - side(y1)), 0.0)
    inside = off <= d
    reach = np.sqrt(np.maximum(d * d - off * off, 0.0))
    c0, c1 = clip[part, 0, None, None], clip[part, 2, None, None]
    left = np.where(inside, np.clip(side(x0) - reach, c0, c1), c0)
    right = np.where(inside, np.clip(side(x1) + reach, c0, c1), c0)
    order = np.argsort(left, 1)
    left, right = np.take_along_axis(left, order, 1), np.take_along_axis(right, order, 1)
    before = np.concatenate([np.broadcast_to(c0, left[:, :1].shape), np.maximum.accumulate(right, 1)[:, :-1]], 1)
    length = np.maximum(right - np.maximum(left, before), 0.0).sum(1)
    return np.bincount(part, (length * weights).sum(1) * (high - low)[:, 0], len(boxes))


def _each(boxes: np.ndarray, clip: np.ndarray, d: float, steps: int) -> np.ndarray:
    n = boxes.shape[1]
    rows = max(1, CHUNK // (n * (8 * n + 2) * steps))
    return np.concatenate([_strips(boxes[i : i + rows], clip[i : i + rows], d, steps) for i in range(0, len(boxes), rows)])


def union_areas(boxes: np.ndarray, part: np.ndarray, clip: np.ndarray, d: float, steps: int = 12) -> np.ndarray:
    """Areas of the unions of boxes (n, 4), dilated by d with round corners, within clips (parts, 4); `part` tells the part of each box.

    Where boxes are crowded a part is cut into four until few boxes are left
    in each, or one covers it, so the work grows with the boxes and not with
    the square of their number.
    """
    total, own = np.zeros(len(clip)), np.arange(len(clip))
    box = np.arange(len(boxes))
    while len(box):
        b, c = boxes[box], clip[part]
        touches = (b[:, 0] - d < c[:, 2]) & (b[:, 2] + d > c[:, 0]) & (b[:, 1] - d < c[:, 3]) & (b[:, 3] + d > c[:, 1])
        box, part = box[touches], part[touches]
        b, c = boxes[box], clip[part]
        wide = (b[:, 0] - d <= c[:, 0]) & (b[:, 2] + d >= c[:, 2]) & (b[:, 1] <= c[:, 1]) & (b[:, 3] >= c[:, 3])
        tall = (b[:, 0] <= c[:, 0]) & (b[:, 2] >= c[:, 2]) & (b[:, 1] - d <= c[:, 1]) & (b[:, 3] + d >= c[:, 3])
        full = np.zeros(len(clip), bool)
        full[part[wide | tall]] = True
        np.add.at(total, own[full], (clip[full, 2] - clip[full, 0]) * (clip[full, 3] - clip[full, 1]))
        box, part = box[~full[part]], part[~full[part]]
        order = np.argsort(part, kind="stable")
        box, part = box[order], part[order]
        count = np.bincount(part, minlength=len(clip))
        first = np.cumsum(count) - count
        small = (count <= FEW) | (np.minimum(clip[:, 2] - clip[:, 0], clip[:, 3] - clip[:, 1]) < LEAST)
        for n in np.unique(count[small & (count > 0)]):
            parts = np.flatnonzero(small & (count == n))
            members, bounds = boxes[box[first[parts][:, None] + np.arange(n)]], clip[parts]
            if n == 1:
                m = members[:, 0]
                whole = (m[:, :2] - d >= bounds[:, :2]).all(1) & (m[:, 2:] + d <= bounds[:, 2:]).all(1)
                w, h = (m[whole, 2:] - m[whole, :2]).T
                np.add.at(total, own[parts[whole]], w * h + 2 * d * (w + h) + math.pi * d * d)
                parts, members, bounds = parts[~whole], members[~whole], bounds[~whole]
            if len(parts):
                np.add.at(total, own[parts], _each(members, bounds, d, steps))
        crowded = np.flatnonzero(~small)
        if not len(crowded):
            break
        row, k = _ragged(count[crowded])
        box = np.tile(box[first[crowded][row] + k], 4)
        part = np.concatenate([row + q * len(crowded) for q in range(4)])
        x0, y0, x1, y1 = clip[crowded].T
        mx, my = (x0 + x1) / 2, (y0 + y1) / 2
        clip = np.concatenate([np.stack(q, 1) for q in ((x0, y0, mx, my), (mx, y0, x1, my), (x0, my, mx, y1), (mx, my, x1, y1))])
        own = np.tile(own[crowded], 4)
    return total
