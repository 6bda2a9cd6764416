"""Deep-shallow sorting of suffixes within groups of texts.

Multikey quicksort orders the suffixes to a shallow depth, eight bytes as one
key. What is still tied then has a long common prefix; blind tries, which
compare at branching places only and check one suffix per insertion, order
each such group to the full length.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32
WORD = 8
# Parts of up to this many suffixes are sorted at once and not partitioned.
SMALL = 64


def order_suffixes(data: bytes, starts: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by group and first ``length`` bytes, and whether each equals the one before.

    ``starts`` are places in ``data`` from which at least ``length`` bytes follow.
    """
    padded = np.frombuffer(data + bytes(WORD), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(padded, WORD)
    order = np.argsort(groups, kind="stable")
    same = np.zeros(len(starts), bool)
    # Of what is still to be ordered: places in the order, whether a part begins there, and the depth to which parts are equal.
    place, depth = np.arange(len(order), dtype=np.int32), np.zeros(len(order), np.int16)
    edge = np.diff(groups[order], prepend=-1) != 0
    while len(place):
        begin = np.flatnonzero(edge)
        sizes = np.diff(begin, append=len(place))
        deep = (depth[begin] >= SHALLOW) | (depth[begin] + WORD > length)
        for at in np.flatnonzero(deep & (sizes > 1)).tolist():
            low = int(place[begin[at]])
            part = order[low : low + int(sizes[at])]
            for leaf in _blind_trie(data, starts, part.copy(), int(depth[begin[at]]), length):
                order[low : low + len(leaf)] = leaf
                same[low + 1 : low + len(leaf)] = True
                low += len(leaf)
        on = np.repeat(~deep & (sizes > 1), sizes)
        place, depth, edge = place[on], depth[on], edge[on]
        if not len(place):
            break
        # A step of multikey quicksort in all parts at once: large ones fall in three around their pivots.
        begin = np.flatnonzero(edge)
        sizes = np.diff(begin, append=len(place))
        number = np.repeat(np.arange(len(begin), dtype=np.int32), sizes)
        key = words[starts[order[place]] + depth].view(">u8").ravel().astype(np.uint64)
        step = np.full(len(place), WORD, np.int16)
        large = (sizes > SMALL)[number]
        if large.any():
            pivots = np.sort(key[[begin, begin + sizes // 2, begin + sizes - 1]], axis=0)[1][number]
            side = (key >= pivots).astype(np.uint64) + (key > pivots)
            step[large & (side != 1)] = 0
            key = np.where(large, side, key)
        rank = np.lexsort((key, number))
        order[place] = order[place[rank]]
        key, depth = key[rank], (depth + step)[rank]
        edge[1:] = (number[1:] != number[:-1]) | (key[1:] != key[:-1])
    return order, same


def _blind_trie(data: bytes, starts: np.ndarray, part: np.ndarray, depth: int, length: int) -> list[list[int]]:
    """Leaves in order; those of equal suffixes hold several places."""
    at = starts[part].tolist()
    root: list = [length, None, [int(part[0])], at[0]]
    for place, start in zip(part[1:].tolist(), at[1:]):
        path, node = [], root
        while node[1] is not None:
            path.append(node)
            node = node[1].get(data[start + node[0]]) or next(iter(node[1].values()))
        other = node[3]
        shared = _common(data, start, other, depth, length)
        if shared == length:
            node[2].append(place)
            continue
        # The highest node that is deeper than what is shared gets a branch above it.
        parent, child = None, root
        for step in [*path[1:], node]:
            if child[0] > shared:
                break
            if child[0] == shared and child[1] is not None:
                break
            parent, child = child, child[1].get(data[start + child[0]], step)
        leaf = [length, None, [place], start]
        if child[0] == shared and child[1] is not None:
            child[1][data[start + shared]] = leaf
            continue
        branch = [shared, {data[child[3] + shared]: child, data[start + shared]: leaf}, None, child[3]]
        if parent is None:
            root = branch
        else:
            parent[1][data[start + parent[0]]] = branch
    leaves, stack = [], [root]
    while stack:
        node = stack.pop()
        if node[1] is None:
            leaves.append(node[2])
        else:
            stack.extend(node[1][byte] for byte in sorted(node[1], reverse=True))
    return leaves


def _common(data: bytes, left: int, right: int, depth: int, length: int) -> int:
    """Length of the common prefix, known to be ``depth`` at least."""
    depth = max(depth, 0)
    a, b = data[left + depth : left + length], data[right + depth : right + length]
    if a == b:
        return length
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return depth + len(a) - (differ.bit_length() + 7) // 8
