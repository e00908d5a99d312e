"""Person records with known matches; the last two of the compound-name case are made up."""

# fixed values: rows, and what is expected of them, that every implementation of these rules is held against
COLUMNS = ["row_id", "Vorname", "Name", "Name2", "Strasse", "HausNummer", "Plz", "Ort", "Geburtstag", "Jahrgang"]


def _both(first, second, strasse, nr, plz, ort, birthday, years=(None, None)):
    birthdays = birthday if isinstance(birthday, tuple) else (birthday, birthday)
    return [(*p, strasse, nr, plz, ort, b, y) for p, b, y in zip((first, second), birthdays, years, strict=True)]


ROWS = [
    *_both(("Max", "Mustermann", ""), ("Max", "Mustermann", ""), "Musterstrasse", "1", "12345", "Musterstadt", "1980-01-15"),
    *_both(("Anna", "Schmidt", ""), ("Schmidt", "Anna", ""), "Schmidtweg", "10", "54321", "Schmidtstadt", "1975-05-20"),
    *_both(("Hans", "Mueller", ""), ("Haus", "Mueller", ""), "Muellerweg", "5", "11111", "Muellerstadt", "1985-03-10"),
    *_both(("Thomas", "Weber", ""), ("Weber", "Tomas", ""), "Weberplatz", "7", "22222", "Weberstadt", "1990-12-01"),
    *_both(("Karl", "Müller", ""), ("Karl", "Mueller", ""), "Müllerstrasse", "3", "33333", "Müllendorf", "1978-08-15"),
    *_both(("Peter", "Wagner", "Franz"), ("Peter", "Wagner", "Josef"), "Wagnerweg", "12", "44444", "Wagnerstadt", "1982-04-20"),
    *_both(("Maria", "Fischer", "Anna"), ("Maria", "Fischer", "anna"), "Fischerplatz", "8", "55555", "Fischerstadt", "1988-06-30"),
    *_both(("Lukas", "Koch", ""), ("Lukas", "Koch", ""), "Kochweg", "15", "66666", "Kochstadt", ("1992-11-25", None), (None, "1992")),
    *_both(("Sophie", "Becker", ""), ("Sophie", "Becker", ""), "Beckerstrasse", "20", "77777", "Beckerstadt", ("1995-03-14", None), (None, "1998")),
    *_both(("Julia", "Hoffmann", ""), ("Julia", "Hoffmann", ""), "Hoffmannweg", "25", "88888", "Hoffmannstadt", ("1987-07-18", None), ("1980", "1987")),
    *_both(("Rita", "Lehner-Stadler", ""), ("Rita", "Lehner", "-Stadler"), "Talstrasse", "42", "964200", "Bergheim", "28.07.1955", ("1955", "1955")),
    *_both(("Hans", "Meyer", ""), ("Hans", "Maier", ""), "Bahnhofstrasse", "10", "8001", "Zürich", "1980-01-01", ("", "")),
    *_both(("Anna", "Schmidt", ""), ("Anna", "Schmitt", ""), "Hauptstrasse", "5", "3000", "Bern", "1975-05-15", ("", "")),
    *_both(("Peter", "Müller", ""), ("Peter", "Miler", ""), "Dorfstrasse", "1", "4000", "Basel", "1990-01-01", ("", "")),
    *_both(("Klaus", "Wagner", ""), ("Vagner", "Klaus", ""), "Seestrasse", "20", "6000", "Luzern", "1985-03-10", ("", "")),
    ("Person", "Different", "", "Other Street", "99", "99999", "Other City", "2000-01-01", None),
]
RECORDS = [(k, *r) for k, r in enumerate(ROWS)]

EXPECTED = {
    **{p: ("exact_normal", 100.0) for p in ((0, 1), (8, 9), (12, 13), (14, 15), (18, 19))},
    (2, 3): ("exact_swapped", 95.0),
    (4, 5): ("fuzzy_normal", 73.75),
    (20, 21): ("fuzzy_normal", 70.0),
    (22, 23): ("fuzzy_normal", 70.0),
    (24, 25): ("fuzzy_normal", 76.42857142857143),
    (26, 27): ("fuzzy_normal", 71.66666666666667),
    (6, 7): ("fuzzy_swapped", 72.72727272727272),
    (28, 29): ("fuzzy_swapped", 70.83333333333334),
}


def frame(spark, rows=RECORDS):
    from linkwerk.sources import records

    schema = "row_id long, " + ", ".join(f"{c} string" for c in COLUMNS[1:])
    return records.canonical(spark.createDataFrame(rows, schema), "row_id")


def row(k, vorname, name, name2="", strasse="Weg", nr="1", plz="12345", ort="Ort", birthday="1980-01-01", year=None):
    return (k, vorname, name, name2, strasse, nr, plz, ort, birthday, year)
