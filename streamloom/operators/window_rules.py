"""The rules of candidate windows over whole recordings in arrays: one reading gives all windows of a version.

Rows come as whole recordings in order of position; every rule is a comparison of
arrays, so a row costs the same whatever its recording's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What a word's text and place tell, as bits of one number.
BITS = ("terminal", "question", "opener", "answer", "chat", "no_clause", "first", "person", "ahead", "go", "mark", "lower", "ends", "change")
FIELDS = ("a", "b", "at", "first_i", "last_i", "at_i")
PAIRS = 2_000_000


def _column(t: pa.Table, name: str) -> pa.Array:
    c = t[name].combine_chunks()
    return c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks)


def _over(values: np.ndarray, limit: float) -> np.ndarray:
    """values > limit, where NaN is the greatest number, as Spark has it."""
    return (values > limit) | np.isnan(values)


def _last(cond: np.ndarray) -> np.ndarray:
    """The row of the last True at or before each row; -1 where there is none."""
    return np.maximum.accumulate(np.where(cond, np.arange(len(cond)), -1))


def _earlier(last: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """_last() of the rows before each row in its recording; -1 where there is none."""
    before = np.concatenate([[-1], last[:-1]])
    return np.where(before >= begin, before, -1)


def _codes(*columns: pa.Array) -> list[np.ndarray]:
    """Numbers of the strings, alike in all columns; -1 for null."""
    d = pa.concat_arrays([c.cast(pa.string()) for c in columns]).dictionary_encode()
    all_ = d.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.split(all_, np.cumsum([len(c) for c in columns])[:-1])


def _lists(c: pa.Array) -> tuple[np.ndarray, pa.Array]:
    return pc.list_parent_indices(c).to_numpy(zero_copy_only=False).astype(np.int64), pc.list_flatten(c)


def _numbers(c: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and which of them are known."""
    return c.to_numpy(zero_copy_only=False), pc.is_valid(c).to_numpy(zero_copy_only=False)


def _recordings(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last row of each recording, and the recording of each row."""
    head = t["k"].to_numpy() == 1
    opening = np.flatnonzero(head)
    return opening, np.append(opening[1:], t.num_rows) - 1, np.cumsum(head) - 1


def _turns(t: pa.Table, group: np.ndarray) -> tuple[np.ndarray, dict]:
    """The recording, and the fields, of each turn, in order of both."""
    row, turn = _lists(_column(t, "turns"))
    return group[row], {f: pc.struct_field(turn, f) for f in ("ord", "start_s", "end_s", "speaker")}


def columns_of(t: pa.Table) -> dict:
    """What windows() asks of a stream whose words have their labels: the columns of stream.stream()."""
    _, _, group = _recordings(t)
    lost_row, lost = _lists(_column(t, "lost"))
    hit_row, hit_ord = _lists(_column(t, "hit_ords"))
    label, lost, turn_label = _codes(_column(t, "speaker"), lost, _turns(t, group)[1]["speaker"])
    gap, gap_known = _numbers(_column(t, "gap_next"))
    bits = t["bits"].to_numpy()
    own = {k: (bits >> BITS.index(k) & 1).astype(bool) for k in ("ends", "change")}
    return own | {"label": label, "lost_row": lost_row, "lost": lost, "turn_label": turn_label, "hit_row": hit_row, "hit_ord": hit_ord.to_numpy(zero_copy_only=False).astype(np.int64), "gap": gap, "gap_known": gap_known, "stretch": t["stretch"].to_numpy()}


def _hits(ws, we, timed, opening, closing, side, ts, te, bucket_s) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, turn, overlap) of every turn that overlaps a word or holds its middle, as stream.hits(); turns in order of recording and start.

    A word meets the turns from the first that may reach it to the last that starts by its end.
    NaN is the greatest number, as Spark has it; such a word meets the turns of the buckets that stream.hits() gives it.
    """
    n = len(ws)
    low, high = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    lo, hi = np.fmin(ws, we), np.maximum(ws, we)
    odd = timed & ~np.isfinite(hi + lo)
    edge = np.searchsorted(side, np.arange(len(opening) + 1))
    for g in np.flatnonzero(np.diff(edge)):
        k, m = slice(opening[g], closing[g] + 1), slice(edge[g], edge[g + 1])
        low[k] = edge[g] + np.searchsorted(np.maximum.accumulate(te[m]), lo[k], "left")
        high[k] = edge[g] + np.searchsorted(ts[m], hi[k], "right")
        o = opening[g] + np.flatnonzero(odd[k])
        low[o], high[o] = edge[g], edge[g + 1]
    size = np.where(timed, np.maximum(high - low, 0), 0)
    parts = []
    upto = np.cumsum(size)
    at = 0
    while at < n:  # at most PAIRS pairs at once, and at least one word
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        s = size[at:to]
        word = np.repeat(np.arange(at, to), s)
        turn = np.arange(len(word)) - np.repeat(np.cumsum(s) - s, s) + low[word]
        at = to
        overlap = np.fmin(we[word], te[turn]) - np.maximum(ws[word], ts[turn])
        mid = (ws[word] + we[word]) / 2
        ok = _over(overlap, 0) | ((ts[turn] <= mid) & (mid <= te[turn]))
        word, turn, overlap = word[ok], turn[ok], overlap[ok]
        if (o := odd[word]).any():
            bucket = lambda v: np.nan_to_num(np.floor(v / bucket_s), nan=0.0)
            b0, b1 = bucket(lo[word]), bucket(hi[word])
            first = np.maximum(b0, bucket(ts[turn]))
            ok = ~o | ((np.minimum(b0, b1) <= first) & (first <= np.maximum(b0, b1)) & (first <= bucket(te[turn])))
            word, turn, overlap = word[ok], turn[ok], overlap[ok]
        parts.append((word, turn, overlap))
    return tuple(np.concatenate(v) for v in zip(*parts))


def _nearest(at, words, opening, closing, group, side, ts, te, ord_) -> np.ndarray:
    """The turn whose edge is nearest to each of `words` (rows in order), as stream.nearest_edge(); -1 without turns."""
    out = np.full(len(words), -1, dtype=np.int64)
    turn = np.tile(np.arange(len(ts)), 2)
    time, of = np.concatenate([ts, te]), np.tile(side, 2)
    o = np.lexsort((ord_[turn], time, of))
    turn, time, of = turn[o], time[o], of[o]
    first = np.append(True, (of[1:] != of[:-1]) | (time[1:] != time[:-1])) if len(of) else np.zeros(0, dtype=bool)
    turn, time, of = turn[first], time[first], of[first]
    edge = np.searchsorted(of, np.arange(len(opening) + 1))
    cut = np.searchsorted(group[words], np.arange(len(opening) + 1))
    for g in np.flatnonzero((np.diff(edge) > 0) & (np.diff(cut) > 0)):
        e, q, v = time[edge[g] : edge[g + 1]], turn[edge[g] : edge[g + 1]], at[cut[g] : cut[g + 1]]
        after = np.searchsorted(e, v, "right")
        before = after - 1
        b, a = np.maximum(before, 0), np.minimum(after, len(e) - 1)
        db, da = np.abs(v - e[b]), np.abs(v - e[a])
        back = (after == len(e)) | ((before >= 0) & ((db < da) | ((db == da) & (ord_[q[b]] < ord_[q[a]]))))
        out[cut[g] : cut[g + 1]] = np.where(back, q[b], q[a])
    return out


def labelled(t: pa.Table, fixed: dict) -> dict:
    """The same of spoken words that have no labels yet: turns assigned, smoothed, cut to sentences and stretches, as stream.stream() does it."""
    opening, closing, group = _recordings(t)
    begin, end = opening[group], closing[group]
    n_rows = t.num_rows
    idx = np.arange(n_rows)
    has_was, has_next = idx > begin, idx < end
    was, nxt = np.maximum(idx - 1, 0), np.minimum(idx + 1, n_rows - 1)
    terminal = (t["bits"].to_numpy() >> BITS.index("terminal") & 1).astype(bool)
    (ws, ws_known), (we, we_known) = _numbers(_column(t, "start_s")), _numbers(_column(t, "end_s"))
    side, turn = _turns(t, group)
    (turn_label,) = _codes(turn["speaker"])
    ord_ = turn["ord"].to_numpy(zero_copy_only=False).astype(np.int64)
    ts, te = (turn[f].to_numpy(zero_copy_only=False) for f in ("start_s", "end_s"))
    timed = ws_known & we_known

    word, at, overlap = _hits(ws, we, timed, opening, closing, side, ts, te, fixed["bucket_s"])
    o = np.lexsort((ord_[at], np.nan_to_num(-np.maximum(overlap, 0), nan=np.inf), word))
    best = o[np.append(True, word[o][1:] != word[o][:-1])] if len(o) else o
    raw = np.full(n_rows, -1, dtype=np.int64)
    raw[word[best]] = turn_label[at[best]]
    hit = np.zeros(n_rows, dtype=bool)
    hit[word] = True
    alone = np.flatnonzero(timed & ~hit)
    near = _nearest((ws[alone] + we[alone]) / 2, alone, opening, closing, group, side, ts, te, ord_)
    raw[alone[near >= 0]] = turn_label[near[near >= 0]]

    pause = fixed["pause"]
    breaks = has_was & ws_known & we_known[was] & _over(ws - we[was], pause)
    run = np.cumsum(breaks)
    new = np.flatnonzero(breaks | ~has_was | (raw != raw[was]))
    stop = np.append(new[1:], n_rows) - 1
    lone = has_was[new] & has_next[stop] & (stop - new + 1 <= fixed["max_island"])
    lone &= (run[was[new]] == run[new]) & (run[nxt[stop]] == run[stop]) & (raw[was[new]] == raw[nxt[stop]]) & (raw[was[new]] != raw[new])
    label = np.repeat(np.where(lone, raw[was[new]], raw[new]), stop - new + 1)

    gap, gap_known = ws[nxt] - we, has_next & ws_known[nxt] & we_known
    ends = ~has_next | (label != label[nxt]) | terminal | (gap_known & _over(gap, pause))
    change = has_was & (label != label[was])
    each = np.unique(np.concatenate([np.stack([word, turn_label[at]], axis=1), np.stack([idx, raw], axis=1)]), axis=0)
    each = each[(each[:, 1] >= 0) & (each[:, 1] != label[each[:, 0]])]
    return {"ends": ends, "change": change, "label": label, "lost_row": each[:, 0], "lost": each[:, 1], "turn_label": turn_label, "hit_row": word, "hit_ord": ord_[at], "gap": gap, "gap_known": gap_known, "stretch": np.cumsum(change)}


def windows(t: pa.Table, of: dict, version: int, classes: list[str], fixed: dict) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(row, class, FIELDS of the windows; first row, words and changes of each recording). row: any of the window's recording. of: columns_of(t) or labelled(t)."""
    near, pair_words, pause = fixed["near"], fixed["pair_words"], fixed["pause"]
    number = {c: k for k, c in enumerate(classes)}
    n_rows = t.num_rows
    idx = np.arange(n_rows)
    take = lambda name: t[name].to_numpy()
    opening, closing, group = _recordings(t)
    begin, end = opening[group], closing[group]
    n = end - begin + 1
    x, i, bits = take("pos").astype(np.int64), take("i").astype(np.int64), take("bits")
    bit = {name: (bits >> k & 1).astype(bool) for k, name in enumerate(BITS)}
    gap, gap_known, label, stretch, ends, change = (of[k] for k in ("gap", "gap_known", "label", "stretch", "ends", "change"))
    lost_row, lost, turn_label = of["lost_row"], of["lost"], of["turn_label"]
    side, turn = _turns(t, group)

    has_was, has_next = idx > begin, idx < end
    was, nxt = np.maximum(idx - 1, 0), np.minimum(idx + 1, n_rows - 1)
    at_or = lambda rows, inside, values, other: np.where(inside, values[np.clip(rows, 0, n_rows - 1)], other)
    i_0, i_n, stretch_n = np.minimum.reduceat(i, opening)[group], np.maximum.reduceat(i, opening)[group], np.maximum.reduceat(stretch, opening)[group]
    i_a, i_b = at_or(idx - near - 1, idx - near - 1 >= begin, i, i_0), at_or(idx + near, idx + near <= end, i, i_n)
    far = idx + near + 1
    i_far, stretch_far = at_or(far, far <= end, i, i_n), at_or(far, far <= end, stretch, stretch_n)
    prev_i, next_i = np.where(has_was, i[was], i), np.where(has_next, i[nxt], i)
    question = bit["question"]
    sent_start = ~has_was | ends[was]
    same_next, same_prev = has_next & (stretch[nxt] == stretch), has_was & (stretch[was] == stretch)
    gap_was_known, gap_was = has_was & gap_known[was], gap[was]
    opens = sent_start | (has_was & bit["mark"][was]) | (gap_was_known & _over(gap_was, fixed["clause_pause"]))
    cue = bit["person"] | (~sent_start & bit["ahead"] & has_was & bit["go"][was])
    n_chat, n_no_clause, n_cue, n_first = (np.cumsum(v) for v in (bit["chat"], bit["no_clause"], cue, bit["first"]))  # only differences inside a recording count
    s, c, st = _last(sent_start), _last(opens), _last(~has_was | change)
    asked_last = _earlier(_last(question), begin)

    found: list[tuple] = []

    def add(cond, cls, a, b, at, first_i, last_i, at_i):
        a, b = np.maximum(a, 0), np.minimum(b, n - 1)
        r = np.flatnonzero(cond & (a < b))
        kind = np.full(len(r), number[cls]) if isinstance(cls, str) else cls[r]
        found.append((r, kind, a[r], b[r], at[r], first_i[r], last_i[r], at_i[r]))

    inside = has_was & ~bit["terminal"][was]
    open_before = change & inside
    size = x - x[s] + 1
    t_gap_known, t_gap = gap_was_known[st], gap_was[st]
    edge = (t_gap_known & _over(t_gap, pause)) | (gap_known & _over(gap, pause))
    left, right = np.where(has_was[st], label[was[st]], -1), np.where(has_next, label[nxt], -1)
    island = (x[st] > 0) & has_next & ~same_next & (left == right) & (label != left) & (x - x[st] + 1 <= fixed["island_words"])
    answer = ends & same_next & question & bit["opener"][nxt]
    reply = ends & same_next & (size <= fixed["address_words"]) & bit["terminal"] & bit["answer"][nxt] & (n_cue > n_cue[s] - cue[s])
    back = ends & same_next & same_prev[s] & (size <= fixed["back_words"]) & (n_chat == n_chat[s] - bit["chat"][s])
    add(change, "shift", x - near - 1, x + near, x, i_a, i_b, i)
    add(island, np.where(edge, number["edge_island"], number["long_island"]), x[st] - 1, x + 1, x[st], prev_i[st], next_i, i[st])
    add(open_before & bit["lower"], "no_punct_lowercase", x - 1, x, x, prev_i, i, i)
    add(change & gap_was_known & (gap_was <= fixed["zero_gap"]), "zero_gap", x - 1, x, x, prev_i, i, i)
    add(open_before & ~(gap_was_known & _over(gap_was, pause)), "inside_sentence", x - 1, x, x, prev_i, i, i)
    add(answer, "question_answer", x[s] - 1, x + 1, x + 1, prev_i[s], next_i, next_i)
    add(reply, "address_reply", x, x + 1, x + 1, i, next_i, next_i)
    add(back, "backchannel", x[s] - 1, x + 1, x[s], prev_i[s], next_i, i[s])

    asks = question & same_next
    pairs: list[tuple] = []
    if version == 1:
        last_of = np.append(np.flatnonzero(st[1:] != st[:-1]), n_rows - 1)
        stop = last_of[np.searchsorted(last_of, idx)]
        none = n_first[st] - bit["first"][st]
        gone = n_first - bit["first"] - none
        lag, lead = idx - fixed["register_window"] - 1, idx + fixed["register_window"] - 1
        fb = gone - at_or(lag, lag >= st, n_first - none, 0)
        fa = at_or(lead, lead <= stop, n_first, n_first[stop]) - none - gone
        turned = sent_start & same_prev & (idx - st >= fixed["register_min"]) & (stop + 1 - idx >= fixed["register_min"]) & (fb == 0) & (fa >= fixed["register_onset"])
        add(turned, "register_change", x - 1, x, x, prev_i, i, i)
    else:
        clause = (~has_next | opens[nxt]) & same_next & same_prev[c] & (x - x[c] + 1 <= fixed["back_words"]) & (n_no_clause == n_no_clause[c] - bit["no_clause"][c]) & ~(sent_start[c] & ends)
        add(clause, "clause_backchannel", x[c] - 1, x + 1, x[c], prev_i[c], next_i, i[c])
        singles, found = found, pairs
        # The question before a backchannel's first word, in its stretch and near enough.
        for cond, span in ((back, s), (clause, c)):
            q = asked_last[span]
            add(cond & (q >= st) & (x[span] - 1 - x[q] < pair_words), "paired_start", x[q], x[q] + 1, x[q] + 1, i[q], next_i[q], next_i[q])
        # A question behind which the stretch goes on: the first one at or behind some window's last word, near enough.
        behind = _earlier(_last(answer | reply | back | clause), begin)
        asked = _earlier(_last(asks), begin)
        due = asks & (behind >= 0) & (behind + 1 >= st) & (x - x[behind] - 1 < pair_words) & ((asked < 0) | (asked < behind + 1))
        add(due, "paired_return", x, x + 1, x + 1, i, next_i, next_i)
        found = singles

    # Labels of raw turns that the rendered stream lost: contested runs.
    raw: list[tuple] = []
    o = np.lexsort((lost_row, lost, group[lost_row]))
    row, what = lost_row[o], lost[o]
    if len(row):
        new = np.append(True, (what[1:] != what[:-1]) | (row[1:] != row[:-1] + 1) | ~has_was[row[1:]])
        lo, hi, what = row[new], row[np.append(new[1:], True)], what[new]
        borders = (has_was[lo] & (label[was[lo]] == what)) | (has_next[hi] & (label[nxt[hi]] == what))
        keep = ~(borders & (x[hi] - x[lo] + 1 <= near))
        lo, hi = lo[keep], hi[keep]
        raw.append((lo, x[lo] - near - 1, x[hi] + near + 1, x[lo], i_a[lo], i_far[hi], i[lo], stretch_far[hi]))
    # Runs of turns that hit no word.
    if len(side):
        ord_ = turn["ord"].to_numpy(zero_copy_only=False).astype(np.int64)
        hit_row, hit_ord = of["hit_row"], of["hit_ord"]
        wide = max([ord_.max(), *([hit_ord.max()] if len(hit_ord) else [])]) + 1
        hit = np.isin(side * wide + ord_, np.unique(group[hit_row] * wide + hit_ord))
        new = np.append(True, (side[1:] != side[:-1]) | (turn_label[1:] != turn_label[:-1]))
        run = np.flatnonzero(new)
        t0 = np.fmin.reduceat(turn["start_s"].to_numpy(zero_copy_only=False), run)
        missed = ~np.logical_or.reduceat(hit, run)
        side, what, t0 = side[run][missed], turn_label[run][missed], t0[missed]
        start, known = _numbers(_column(t, "start_s"))
        start = np.where(known, np.where(np.isnan(start), np.inf, start), -np.inf)
        first = np.zeros(len(side), dtype=np.int64)  # the first word that starts at t0 or later
        cut = np.append(np.flatnonzero(np.append(True, side[1:] != side[:-1])), len(side)) if len(side) else np.zeros(1, dtype=np.int64)
        for lo, hi in zip(cut[:-1], cut[1:]):
            g = side[lo]
            reached = np.maximum.accumulate(start[opening[g] : closing[g] + 1])
            first[lo:hi] = opening[g] + np.searchsorted(reached, t0[lo:hi])
        ok = (first <= closing[side]) & (first > opening[side])
        row, what = first[ok], what[ok]
        held = np.zeros(len(row), dtype=bool)
        for d in range(-near, near):
            r = np.clip(row + d, 0, n_rows - 1)
            held |= (row + d >= begin[row]) & (row + d <= end[row]) & (label[r] == what)
        row = row[~held]
        raw.append((row, x[row] - near - 1, x[row] + near, x[row], i_a[row], i_b[row], i[row], at_or(row + near, row + near <= end[row], stretch, -1)))
    behind_raw = []
    for row, a, b, *rest, stretch_b in raw:
        a, b = np.maximum(a, 0), np.minimum(b, n[row] - 1)
        ok = a < b
        found.append((row[ok], np.full(ok.sum(), number["dropped_raw_change"]), a[ok], b[ok], *[v[ok] for v in rest]))
        behind_raw.append((begin[row[ok]] + b[ok], stretch_b[ok]))
    if version == 2:
        # The transition behind the first question at or behind the last word of a dropped label's window, in its stretch and near enough.
        asking = np.flatnonzero(asks)
        for last, stretch_b in behind_raw:
            k = np.searchsorted(asking, last)
            ok = k < len(asking)
            last, stretch_b, q = last[ok], stretch_b[ok], asking[k[ok]]
            q = q[(group[q] == group[last]) & (stretch[q] == stretch_b) & (x[q] - x[last] < pair_words)]
            pairs.append((q, np.full(len(q), number["paired_return"]), x[q], x[q] + 1, x[q] + 1, i[q], next_i[q], next_i[q]))
        each = np.concatenate([np.stack([begin[p[0]], *p[1:]], axis=1) for p in pairs])
        found.append(tuple(np.unique(each, axis=0).T))
    row, kind, *values = (np.concatenate(v) for v in zip(*found))
    return row, kind, dict(zip(FIELDS, values)), opening, closing - opening + 1, np.add.reduceat(change.astype(np.int64), opening)
