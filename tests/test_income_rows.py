"""Statement rows to concepts: printed examples, and random rows against a plain walk over them."""

import random
from decimal import Decimal

from finloom.operators.income_rows import mapped

LINES = "doc int, statement string, row_no int, label string, concept string, cells array<string>"
PAT, TCI, OWN, NCI, PERP = "is.profit_for_period", "is.total_comprehensive_income", "is.pat_owners", "is.pat_nci", "is.pat_perpetual_bond"


def run(spark, statements, kind="IS"):
    rows = [(d, kind, i, *row) for d, statement in enumerate(statements) for i, row in enumerate(statement)]
    got = mapped(spark.createDataFrame(rows, LINES)).collect()
    out = [[] for _ in statements]
    for r in sorted(got, key=lambda r: (r.doc, r.row_no, r.concept or "")):
        out[r.doc].append((r.row_no, r.concept, [None if x is None else float(x) for x in r.figures]))
    return out


HEAD = [("Profit for the financial year", PAT, ["10", "6"])]


def concepts(found):
    return [(n, c) for n, c, _ in found]


def test_earnings_per_share_layouts(spark):
    layouts = [
        [("Earnings per share attributable to owners of the Company (sen):", None, []), ("- Basic", None, ["2.45", "1.45"]), ("- Diluted", None, ["2.40", "1.44"])],
        [("Basic/diluted earnings per", None, []), ("share (sen)", None, ["2.45", "1.45"])],
        [("Earnings per share attributable to", None, []), ("owners of the parent (sen)", None, []), ("Basic", None, ["2.45", "1.45"]), ("Diluted", None, ["2.40", "1.44"])],
        [("Other comprehensive income", None, ["420", "150"]), ("Basic", None, ["12", "15"])],
        [("Earnings per unit (sen)", None, []), ("— Basic", None, ["16.06", "14"]), ("– Diluted", None, ["16.05", "14"]), ("Distribution per unit (sen)", "is.dpu", ["10.7", "10"])],
        [("Earnings per share (sen)", None, ["2.45", "1.45"])],
        [("Earnings per share", None, ["28"]), ("(a) Basic (sen)", None, ["2.45", "1.45"])],
        [("Basic earnings per share (sen)", None, []), ("- from continuing operations", None, ["2.00", "1"]), ("- from discontinued operations", None, ["0.45", "1"])],
        [("Earnings per share", None, []), ("Total comprehensive income attributable to:", None, []), ("Owners of the Company", OWN, ["9", "5"])],
        [("Earnings per share (RM)", None, []), ("- Basic", None, ["0.12", "0.1"])],
        [("Earnings per share from continuing operations (sen)", None, ["2.00", "1"]), ("Proﬁt per share (sen)", None, ["2.45", "1"]), ("Earnings per share (sen)", None, ["9", "9"])],
        [("Earnings per ordinary share attributable to owners of the Company (sen):", None, []), ("Basic and diluted:", None, []), ("Profit for the financial year", PAT, ["2.45", "1.45"])],
    ]
    got = [[(n - 1, c, f) for n, c, f in rows if n > 0] for rows in run(spark, [HEAD + x for x in layouts])]
    both, b, d = ["is.eps_basic", "is.eps_diluted"], "is.eps_basic", "is.eps_diluted"
    assert got[0] == [(1, b, [2.45, 1.45]), (2, d, [2.4, 1.44])]
    assert got[1] == [(1, k, [2.45, 1.45]) for k in both]
    assert concepts(got[2]) == [(2, b), (3, d)]
    assert concepts(got[3]) == [(0, None), (1, None)]
    assert concepts(got[4]) == [(1, b), (2, d), (3, "is.dpu")]
    assert concepts(got[5]) == [(0, b)]
    assert concepts(got[6]) == [(1, b)]
    assert concepts(got[7]) == [(1, None), (2, None)]
    assert concepts(got[8]) == [(2, OWN)]
    assert got[9] == [(1, b, [12.0, 10.0])]
    assert concepts(got[10]) == [(0, None), (1, b), (2, None)]
    assert concepts(got[11]) == [(2, k) for k in both]


def test_sections_by_order_and_repeated_profits(spark):
    pat, tci = ("Profit for the year", PAT, ["10", "6"]), ("Total comprehensive income", TCI, ["12", "7"])
    own, nci, perp = ("Owners", OWN, ["9", "5"]), ("NCI", NCI, ["1", "1"]), ("Perpetual", PERP, ["0", "-"])
    got = run(spark, [
        [pat, own, nci, tci, own, nci],
        [pat, tci, own, nci, own, nci],
        [pat, tci, perp, nci, own, perp, nci, own],
        [pat, tci, own, own, nci],
        [("Taxation", "is.tax_expense", ["3", "2"]), pat, ("Taxation", "is.tax_expense", ["1", "1"]), ("for the financial year", None, ["12", "7"]), own, own],
        [pat, ("Profit from discontinued", None, ["1", "1"]), ("Profit for the year", PAT, ["11", "7"]), own],
        [pat, pat, tci],
        [pat, tci, ("Profit for the year", PAT, ["2.4", "1.4"])],
        [pat, own, ("Owners", OWN, []), ("- from continuing operations", None, ["4", "3"]), ("- from discontinued operations", None, ["(1)", "-"]), nci],
        [pat, ("Owners", OWN, []), ("Something", None, ["1"]), ("from continuing operations", None, ["4"])],
    ])
    t = {OWN: "is.tci_owners", NCI: "is.tci_nci"}
    assert concepts(got[0]) == [(0, PAT), (1, OWN), (2, NCI), (3, TCI), (4, t[OWN]), (5, t[NCI])]
    assert concepts(got[1]) == [(0, PAT), (1, TCI), (2, OWN), (3, NCI), (4, t[OWN]), (5, t[NCI])]
    assert [c for _, c, _ in got[2]] == [PAT, TCI, PERP, NCI, OWN, None, t[NCI], t[OWN]]
    assert [c for _, c, _ in got[3]] == [PAT, TCI, OWN, t[OWN], t[NCI]]
    assert [c for _, c, _ in got[4]] == ["is.tax_expense", PAT, None, TCI, OWN, t[OWN]]
    assert [c for _, c, _ in got[5]] == ["is.profit_continuing", None, PAT, OWN]
    assert [c for _, c, _ in got[6]] == [PAT, None, TCI]
    assert [c for _, c, _ in got[7]] == [PAT, TCI, None]
    assert got[8][1:] == [(1, OWN, [9.0, 5.0]), (2, OWN, [3.0, 3.0]), (5, NCI, [1.0, 1.0])]
    assert concepts(got[9]) == [(0, PAT), (2, None), (3, None)]


#: Labels by what they are; a walk knows them by these marks and not by their words.
POOL = [
    ("Profit for the year", PAT, "tail"), ("Total comprehensive income", TCI, "foreign"), ("Owners of the Company", OWN, "tail"), ("Minority", NCI, ""), ("Perpetual", PERP, ""),
    ("Taxation", "is.tax_expense", "foreign"), ("Sundry", None, ""), ("Earnings per share (sen)", None, "heads tail"), ("- Basic", None, "sub"), ("Diluted", None, "sub"),
    ("Basic and diluted earnings per unit", None, "heads sub tail"), ("from continuing operations", None, "part"), ("for the parent", None, "tail"),
]


def walk(rows):
    """The rows one after another, with a state."""
    out, seen, past, first, tci, anchors, block, met, sums = [], False, False, None, False, [], 0, set(), None
    eps, used, lines = None, False, 0

    def flush():
        nonlocal sums
        if sums and sums[2] is not None:
            out.append([sums[0], sums[1], [sums[2]], None])
        sums = None

    def owner(concept):
        nonlocal block, met
        if concept in met:
            block, met = block + 1, set()
        met.add(concept)
        under = anchors[block] if block < len(anchors) else None
        return {OWN: "is.tci_owners", NCI: "is.tci_nci"}.get(concept) if under == TCI else concept

    for n, (label, concept, marks, value) in enumerate(rows):
        heads, sub, tail, foreign = ("heads" in marks), ("sub" in marks), ("tail" in marks), ("foreign" in marks)
        if seen or past:
            taken, keys = True, None
            if value is None:
                if eps is not None and not used and lines < 4 and not foreign:
                    eps, lines = f"{eps} {label}", lines + 1
                elif heads:
                    eps, used, lines = label, False, 1
                else:
                    eps, taken = None, False
            elif eps is not None and (sub or (not used and not heads and tail)):
                used, keys = True, eps
            elif heads:
                eps, used, lines, keys = label, True, 1, label
            else:
                eps, taken = None, False
            if taken:
                flush()
                if value is not None:
                    both, own = f"{keys} {label}".lower(), label.lower()
                    source = own if "basic" in own or "dilut" in own else keys.lower()
                    names = (["is.eps_basic"] if "basic" in source or "dilut" not in source else []) + (["is.eps_diluted"] if "dilut" in source else [])
                    if "continuing" in own:
                        names = []
                    out.append([n, names, [value], int("continuing" in both)])
                continue
        if sums is not None and "part" in marks:
            sums[2] = value if sums[2] is None else sums[2] if value is None else sums[2] + value
            continue
        if value is None:
            past = past or label == "Profit for the year"
            if seen and concept in (OWN, NCI, PERP):
                flush()
                sums = [n, owner(concept), None]
            continue
        flush()
        if seen and concept == "is.tax_expense":
            concept = None
        if concept == PAT:
            past = True
            if seen:
                if tci or value == first[2][0]:
                    concept = None
                else:
                    first[1] = "is.profit_continuing"
            else:
                seen = True
                anchors.append(PAT)
        elif concept == TCI:
            past = tci = True
            anchors.append(TCI)
        elif concept in (OWN, NCI, PERP):
            past, concept = True, owner(concept)
        out.append([n, concept, [value], None])
        if seen and first is None:
            first = out[-1]
    flush()
    final = [(n, c, f) for n, c, f, later in out if later is None]
    shares = [(n, c, f, later) for n, c, f, later in out if later is not None]
    best = {k: min((later, n) for n, c, _, later in shares if k in c)[1] for k in ("is.eps_basic", "is.eps_diluted") if any(k in c for _, c, _, _ in shares)}
    for n, c, f, _ in shares:
        won = [k for k in c if best[k] == n]
        final += [(n, k, f) for k in won] or [(n, None, f)]
    return sorted(final, key=lambda r: (r[0], r[1] or ""))


def test_random_statements_equal_a_walk(spark):
    draw = random.Random(11)
    statements = [[(*draw.choice(POOL), draw.choice([None, None, 101, 102, 103])) for _ in range(draw.randint(1, 24))] for _ in range(400)]
    got = run(spark, [[(label, concept, [] if value is None else [str(value)]) for label, concept, _, value in s] for s in statements])
    want = [[(n, c, [float(x) for x in f]) for n, c, f in walk(s)] for s in statements]
    wrong = [(s, g, w) for s, g, w in zip(statements, got, want) if g != w]
    assert not wrong, (len(wrong), wrong[0])


def test_empty_rows_and_other_statements(spark):
    assert run(spark, [[(None, None, ["1"]), ("", None, ["2"]), ("Sundry", None, None)]]) == [[]]
    rows = [("Profit for the year", PAT, ["10"]), ("Earnings per share (sen)", None, ["2"])]
    assert run(spark, [rows], kind="CF") == [[(0, PAT, [10.0]), (1, None, [2.0])]]
    assert mapped(spark.createDataFrame([], LINES)).collect() == []
    assert Decimal("1.5") == mapped(spark.createDataFrame([(1, "IS", 0, "Sundry", None, ["1.5"])], LINES)).first().figures[0]
