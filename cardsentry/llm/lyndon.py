"""Suffix order by linear grouping, for many small collections at once.

The construction has two phases and renames nothing:

1. Suffixes are grouped by their Lyndon prefix (the prefix up to the next
   smaller suffix). Groups begin as characters and are finished in descending
   order. For each suffix of a group being finished, the previous-smaller
   pointer leads to the last suffix before it whose group is lower. What
   points to there extends that suffix's prefix: it moves, by how often it
   was pointed to, into a new group just above its own.
2. Groups are emitted in ascending order. A suffix that is emitted settles,
   in their own groups, the places of all suffixes whose Lyndon prefix ends
   where it starts.

Collections ("lanes") never compare with each other, so all lanes take each
step together and numpy works on the current groups of all of them.
"""

from __future__ import annotations

import numpy as np


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The ranges start[i], ..., start[i] + count[i] - 1, one after the other."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(start - (ends - count), count)


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


class Strings:
    """Strings of several lanes laid out one after the other, each between
    two stop places. ``lane`` holds the lane of each string, ascending."""

    def __init__(self, strings: list[bytes], lane: np.ndarray):
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.begin = np.cumsum(sizes + 1) - sizes  # the stop before a string is at begin - 1
        self.end = self.begin + sizes
        self.text = np.frombuffer(b"\0" + b"\0".join(strings) + b"\0" * 9, np.uint8)
        self.n = int(self.end[-1]) + 1
        self.lane = np.asarray(lane, np.int64)
        self.place = _ranges(self.begin, sizes)  # of all suffixes
        self.string = np.repeat(np.arange(len(strings)), sizes)


def suffix_order(s: Strings) -> np.ndarray:
    """The places of all suffixes, lane by lane, in lexicographic order; of
    suffixes that are equal the one of the earlier string comes first."""
    n, place = s.n, s.place
    if not len(place):
        return place
    of = s.lane[s.string]
    first = of * 256 + s.text[place]
    by = np.argsort(first, kind="stable")
    order = place[by]
    first = first[by]
    slot = np.zeros(n, np.int64)
    slot[order] = np.arange(len(order))
    head = _heads(first)
    n_groups = len(head)
    start = np.zeros(n_groups + len(order) + 1, np.int64)
    stop = start.copy()
    length = np.ones_like(start)
    start[:n_groups] = head
    stop[:n_groups] = np.append(head[1:], len(order))
    group = np.full(n, -1, np.int64)
    group[order] = np.repeat(np.arange(n_groups), stop[:n_groups] - start[:n_groups])
    lane_head = _heads(of)  # by lane, the order has the same bounds
    lane_stop = np.append(lane_head[1:], len(of))

    _group(order, slot, group, start, stop, length, n_groups, lane_head, lane_stop.copy())
    return _emit(s, order, group, start, stop, length, lane_head, lane_stop)


def _group(order, slot, group, start, stop, length, n_groups, low, high) -> None:
    """Phase 1, in place: groups become intervals of ``order`` with final lengths."""
    n = len(slot)
    done = np.zeros(n, bool)
    moving = np.zeros(n, bool)
    before = np.arange(n) - 1  # previous-smaller pointers
    while len(low):
        g = group[order[high - 1]]
        at = start[g]
        now = np.sort(order[_ranges(at, high - at)])
        high = at
        done[now] = True
        p = before[now]
        todo = np.flatnonzero(done[p])
        while len(todo):
            before[now] = p
            p[todo] = before[p[todo]]
            todo = todo[done[p[todo]]]
        before[now] = p
        # in order of place, what points to the same suffix stands together
        run = _heads(p)
        target = p[run]
        times = np.diff(run, append=len(p))
        size = length[group[now[run]]]
        real = group[target] >= 0  # stops have no group
        target, times, size = target[real], times[real], size[real]
        if len(target):
            own = group[target]
            by = np.lexsort((times, own))
            target, times, size, own = target[by], times[by], size[by], own[by]
            head = _heads(own)
            count = np.diff(head, append=len(own))
            tail = stop[own[head]] - count
            to = _ranges(tail, count)
            was = slot[target]
            moving[target] = True
            there = order[to]
            stays = there[~moving[there]]
            moving[target] = False
            free = was[was < np.repeat(tail, count)]
            order[free] = stays
            slot[stays] = free
            order[to] = target
            slot[target] = to
            stop[own[head]] = tail
            fresh = _heads(own, times)
            ids = n_groups + np.arange(len(fresh))
            n_groups += len(fresh)
            sizes = np.diff(fresh, append=len(own))
            start[ids] = to[fresh]
            stop[ids] = to[fresh] + sizes
            length[ids] = length[own[fresh]] + times[fresh] * size[fresh]
            group[target] = np.repeat(ids, sizes)
        more = high > low
        low, high = low[more], high[more]


def _emit(s: Strings, order, group, start, stop, length, at, end) -> np.ndarray:
    """Phase 2: the order within the groups."""
    ends_at = s.place + length[group[s.place]]  # where the Lyndon prefix ends
    by = np.argsort(ends_at, kind="stable")
    waiting = s.place[by]
    bound = np.searchsorted(ends_at[by], np.arange(s.n + 1))
    out = np.full(len(order), -1, np.int64)
    fill = start.copy()
    frontier = s.end  # the stop after each string, string by string
    while True:
        child = waiting[_ranges(bound[frontier], bound[frontier + 1] - bound[frontier])]
        if len(child):
            g = group[child]
            by = np.argsort(g, kind="stable")
            child, g = child[by], g[by]
            head = _heads(g)
            count = np.diff(head, append=len(g))
            out[_ranges(fill[g[head]], count)] = child
            fill[g[head]] += count
        more = at < end
        at, end = at[more], end[more]
        if not len(at):
            return out
        here = fill[group[order[at]]]
        frontier = out[_ranges(at, here - at)]
        at = here


def equal_windows(s: Strings, order: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, class): all windows of ``size`` bytes in the given order, and a
    number that windows share if they are equal and of one lane."""
    last = np.zeros(s.n, np.int64)
    string = last.copy()
    last[s.place] = s.end[s.string] - size
    string[s.place] = s.string
    places = order[order <= last[order]]
    a, b = places[:-1], places[1:]
    same = np.flatnonzero(s.lane[string[a]] == s.lane[string[b]])
    words = np.ndarray(shape=(len(s.text) - 7,), dtype="<u8", buffer=s.text, strides=(1,))
    for off in [*range(0, size - 7, 8), size - 8]:
        same = same[words[a[same] + off] == words[b[same] + off]]
    new = np.ones(len(places), bool)
    new[same + 1] = False
    return places, np.cumsum(new) - 1
