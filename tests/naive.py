"""Step-by-step roll-up in plain Python, to compare the planned one with."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal


def cents(value):
    return None if value is None else value.quantize(Decimal("0.01"), ROUND_HALF_UP)


def open_accounts(accounts, odate):
    """accounts: (account, status, cutoff); one entry per surviving row."""
    newest = {}
    for account, _, cutoff in accounts:
        if account is not None and cutoff is not None and cutoff <= odate:
            newest[account] = max(newest.get(account, cutoff), cutoff)
    return [
        a
        for a, status, cutoff in accounts
        if a is not None and newest.get(a) == cutoff and status is not None and status != "T"
    ]


def roll_up(movements, accounts, catalogue, subtotals, totals, total_by, round_rows, odate):
    """movements: (account, key, amount); catalogue: (key, code, sender, product, sub)."""
    held = [m for m in movements for a in open_accounts(accounts, odate) if m[0] == a]
    groups = defaultdict(list)
    for account, key, amount in held:
        if key is not None:
            groups[account, key].append(cents(amount) if round_rows else amount)
    detail = []
    for (account, key), amounts in groups.items():
        detail.append((account, key + "IMP", cents(sum(amounts))))
        detail.append((account, key + "OPE", cents(Decimal(len(amounts)))))

    def look_up(rows):
        return [(a, c, amount, pk) for a, pk, amount in rows for c in catalogue if c[0] == pk and pk]

    level1 = look_up(detail)
    by_code = defaultdict(Decimal)
    for account, concept, amount, _ in level1:
        by_code[account, concept[1]] += amount
    subs = [(a, subtotals.get(code), amount) for (a, code), amount in by_code.items()]
    if total_by == "product":
        level2 = look_up(subs)
        by_product = defaultdict(Decimal)
        for account, concept, amount, _ in level2:
            by_product[account, concept[3]] += amount
        tots = [(a, totals.get(p), amount) for (a, p), amount in by_product.items()]
        level3 = look_up(tots)
        everything = [(a, pk, amount) for a, _, amount, pk in level1 + level2 + level3]
    else:
        by_total = defaultdict(Decimal)
        for (account, code), amount in by_code.items():
            by_total[account, totals.get(code)] += amount
        tots = [(a, key, amount) for (a, key), amount in by_total.items()]
        everything = [(a, pk, amount) for a, _, amount, pk in level1] + subs + tots
    return [
        (a, c[1], c[2], c[3], c[4], cents(amount), odate) for a, c, amount, _ in look_up(everything)
    ]
