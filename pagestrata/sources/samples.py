"""Hand-made pages that hold evidence the test tables lack: every class, captions, dates, phones, scales, front pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_LINES = [
    "Fig. 1 Bohrprofil", "Figure 2.1: log of borehole", "Tab 3.1.2", "1.2.3", "This is Fig. 1", "12 Sand", "123 m", "Abbildungen are useful", "01.02.2001", "januar 2000", "mai 2000", "2026", "märz 1850",
    "tel. 044 123 45 67", "0041 44 123 45 67", "044 123 45 67", "tel +41 44 123 45 67", "+41 44 123 45 67", "1:25000", "1:50'000", "1:100'000", "1:25'000", "1:500", "1 : 25000", "Kies und Sand, grau", "projekt sand",
    "geologischer schnitt", "längsprofil A", "bohrung 12", "Projekt Bericht", "legende karte", "karte tabelle",
]
# doc_id, text, lang; line segments of the test vectors belong to page 1 of documents -1, -2, ...
SAMPLES = [
    (-1, "Legende\nBern\nTHUN\nBasel Nord\n1:25000", "de"),
    (-2, "Bern\nTHUN\nBasel Nord\nZug\nChur\nBiel\nAarau\nKloten", "de"),
    (-3, "der Kies und die Bohrung\nnicht grau\nSand", "de"),
    (-4, "\n".join(f"{i}.5 Sand Kies" for i in range(12)) + "\nBohrung 7", "de"),
    (-5, "\n".join(f"{i},5m gravier et sable" for i in range(9)) + "\nForage les dans", "fr"),
    (-6, "Geologischer Schnitt\nund die Karte\nnicht das Projekt", "de"),
    (-7, "geological cross-section\nthe of and\nNorth to South", "en"),
    (-11, "Projekt Nord\nBericht 2001\nTeil eins\nBern", "de"),
    (-12, "rapport final\ndans les Alpes\ntel. 044 123 45 67\n01.02.2001", "fr"),
    (-13, "the gravel and the brown\nlayers of the river\nunder the water is stone", "en"),
    (-14, "Fig. 1 Bohrprofil Bohrung\nSand\nKies", "de"),
    (-15, "x", None),
    (-20, "\n".join(_LINES), "de"),
    (-21, "PAGE DE GARDE No AGS numéro ou signe distinctif original Commettants\nRéseau km", "fr"),
    (-22, "PAGE DE GARDE No AGS Commettants", "fr"),
]


def samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SAMPLES, "doc_id long, text string, lang string")
