"""Byte-pair merging over a heap of pair ranks and a linked list of symbols.

``pairs`` maps two packed symbol ids to the rank of their merge and the merged id, packed too.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

ID_BITS = 20
_ID = (1 << ID_BITS) - 1
_AT_BITS = 32
_AT = (1 << _AT_BITS) - 1


def pair_table(vocab: dict[str, int], merges: list) -> dict[int, int]:
    table = {}
    for rank, (left, right) in enumerate(merges):
        key = vocab[left] << ID_BITS | vocab[right]
        table[key] = rank << ID_BITS | vocab[left + right]
    return table


def heap_merge(symbols: list[int], pairs: dict[int, int]) -> int:
    """Merge ``symbols`` in place and return the number of merges.

    The lowest rank goes first, the leftmost of equal ones. A merged pair leaves its id at the
    left place and -1 at the right one. Heap entries whose pair has changed are passed over.
    """
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for at in range(n - 1):
        found = pairs.get(symbols[at] << ID_BITS | symbols[at + 1])
        if found is not None:
            heap.append(found >> ID_BITS << _AT_BITS | at)
    heapify(heap)
    merges = 0
    while heap:
        entry = heappop(heap)
        at = entry & _AT
        left, right_at = symbols[at], after[at]
        if left < 0 or right_at >= n:
            continue
        found = pairs.get(left << ID_BITS | symbols[right_at])
        if found is None or found >> ID_BITS != entry >> _AT_BITS:
            continue
        merged = symbols[at] = found & _ID
        symbols[right_at] = -1
        merges += 1
        following = after[at] = after[right_at]
        if following < n:
            before[following] = at
            found = pairs.get(merged << ID_BITS | symbols[following])
            if found is not None:
                heappush(heap, found >> ID_BITS << _AT_BITS | at)
        previous = before[at]
        if previous >= 0:
            found = pairs.get(symbols[previous] << ID_BITS | merged)
            if found is not None:
                heappush(heap, found >> ID_BITS << _AT_BITS | previous)
    return merges
