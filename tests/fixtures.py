"""Hand-computed fixtures (FIXTURES.md sections 3-5) as CSV text."""

CENTRES_CSV = """area,centre,kind
ABR,C1,T
ABR,C2,T
BAS,C3,T
XXX,C4,T
"""

SUMMARY_CSV = """date,area,total,extra
2021-01-01,ABR,1000,x
2021-01-02,ABR,620,x
2021-01-15,ABR,630,x
2021-02-10,BAS,85,x
2021-03-05,CAL,500,x
2021-04-10,ABR,59,x
2021-05-31,BAS,999,x
"""

# date, supplier, area, age band, decoy, women
DETAIL_ROWS = [
    ("2021-02-01", "P", "ABR", 5, 10),
    ("2021-02-01", "M", "ABR", 1, 2),
    ("2021-02-02", "P", "ABR", 0, 14),
    ("2021-03-01", "P", "ABR", 0, 31),
    ("2021-03-31", "P", "ABR", 0, 61),
    ("2021-02-01", "P", "BAS", 0, 10),
    ("2021-02-05", "P", "BAS", 4, 0),
    ("2021-02-01", "P", "CAL", 0, 5),
    ("2021-02-02", "P", "CAL", 9, 0),
    ("2021-02-03", "P", "CAL", 0, 5),
    ("2021-02-01", "P", "MOL", 0, 3),
    ("2021-02-02", "P", "MOL", 0, 1),
    ("2021-01-31", "P", "PIE", 0, 500),
    ("2021-02-10", "P", "PIE", 0, 7),
    ("2021-02-20", "P", "PIE", 0, 12),
    ("2021-02-03", "P", "LAZ", 0, 14),
    ("2021-02-13", "P", "LAZ", 0, 19),
    ("2021-02-03", "P", "VEN", 0, 14),
    ("2021-02-13", "P", "VEN", 0, 19),
    ("2021-02-01", "P", "LOM", 0, 1),
    ("2021-02-02", "P", "LOM", 0, 1),
]

DETAIL_CSV = "date,supplier,area,age_band,other,women,extra\n" + "".join(
    f"{d},{s},{a},20-29,{o},{w},z\n" for d, s, a, o, w in DETAIL_ROWS)

C1_EXPECTED = [("ABR", 1, 20), ("ABR", 4, 0), ("BAS", 2, 3)]
C3_EXPECTED = {
    ("ABR", "Jan"): 36.290323,
    ("ABR", "Apr"): 0.983333,
    ("BAS", "Feb"): 3.035714,
    ("BAS", "May"): 32.225806,
}
C2_EXPECTED = [
    ("2021-03-01", "20-29", [(68, "ABR"), (27, "LAZ"), (27, "VEN"), (16, "PIE"), (3, "CAL")]),
    ("2021-04-01", "20-29", [(62, "ABR")]),
]
C2_FULL_RANKING = {
    "2021-03-01": [(68, "ABR"), (27, "LAZ"), (27, "VEN"), (16, "PIE"), (3, "CAL"),
                   (1, "LOM"), (-53, "MOL")],
    "2021-04-01": [(62, "ABR")],
}
