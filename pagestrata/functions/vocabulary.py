"""Keyword groups, front-page templates and label names."""

# fixed values: page classes in order
CLASSES = ["text", "boreprofile", "map", "geo_profile", "title_page", "diagram", "table", "unknown"]
STABLE = ["text", "boreprofile", "map", "title_page", "unknown"]
APP_LABELS = {"text": "Text", "boreprofile": "Boreprofile", "map": "Maps", "title_page": "Title_Page", "unknown": "Unknown"}
ALIASES = {"borehole": "boreprofile", "boreholes": "boreprofile", "geo profile": "geo_profile", "geological profile": "geo_profile", "geo_profile": "geo_profile", "geoprofile": "geo_profile", "title": "title_page", "title_page": "title_page", "maps": "map"}

# fixed values: keywords of material descriptions, included
MATERIAL = {
    "de": ["sand", "silt", "kies", "asphalt", "humus", "braun", "grau", "weich", "hart", "wurzel", "belag", "stein", "beige", "beton", "kreide", "mergel", "kernmaterial", "dito"],
    "fr": ["sol", "végétal", "dallage", "terre", "bitume", "bitumineux", "grave d'infrastructure", "sable", "limon", "gravier", "asphalte", "humus", "brun", "gris", "grise", "mou", "dur", "dure", "ferme", "racine", "revetement", "pierre", "beige", "beton", "craie", "marne", "materiau", "matrice sableuse", "enrobé", "terrain", "remblais", "remblai", "molasse", "phase", "formations", "limoneuse", "argileuse", "argileux", "mousse"],
    "it": ["sabbia", "limo", "ghiaia", "asfalto", "humus", "marrone", "grigio", "morbido", "duro", "radice", "rivestimento", "pietra", "beige", "cemento", "gesso", "marna", "materiale di carota", "idem"],
    "en": ["sand", "sandy", "sandstone", "silt", "silty", "siltstone", "clay", "claystone", "gravel", "asphalt", "humus", "brown", "gray", "soft", "hard", "root", "surface layer", "stone", "beige", "concrete", "chalk", "marl", "core material", "limestone", "ditto", "alternation", "leucosome"],
}
# fixed values: keywords of material descriptions, excluded
MATERIAL_NOT = {
    "de": ["herr", "ende", "profil", "beschreibung", "signaturen", "mischprobe", "projekt", "ort", "adresse", "wetter", "pumpversuch", "kernbohrung", "bohrradius"],
    "fr": ["monsieur", "fin", "profil", "description", "signatures", "echantillon mixte", "projet", "lieu", "adresse", "temps", "essai de pompage", "carottage", "rayon de forage", "remarque", "piezometre", "profondeur", "désignation"],
    "it": ["signore", "fine", "profilo", "descrizione", "legende", "campione misto", "progetto", "luogo", "indirizzo", "meteo", "prova di pompaggio", "carotaggio", "raggio di perforazione"],
    "en": ["Mr.", "end", "profile", "description", "signatures", "mixed sample", "project", "location", "address", "weather", "pump test", "core drilling", "drilling radius"],
}
# fixed values: keywords of maps, included and excluded
MAP = {
    "en": ["legend", "map", "map key", "map symbols", "features", "scale", "sheet", "contour interval", "topographic", "elevation"],
    "de": ["legende", "karte", "kartenzeichen", "massstab", "blatt", "höhenlinien", "topographisch", "höhe", "situation"],
    "fr": ["carte", "légende", "symboles", "échelle", "planche", "courbes de niveau", "altitude", "topographique", "situation"],
    "it": ["mappa", "legenda", "simboli", "scala", "foglio", "equidistanza", "curve di livello", "altimetrico", "situazione"],
}
MAP_NOT = {
    "en": ["diagram", "graph", "table", "chart"],
    "de": ["diagramm", "grafik", "tabelle", "schaubild", "bohrprofil"],
    "fr": ["diagramme", "graphique", "tableau", "schéma"],
    "it": ["diagramma", "grafico", "tabella", "schema"],
}
# fixed values: keywords of borehole profiles, title pages, geological profiles
BOREPROFILE = {
    "en": ["borehole profile", "boreprofile", "borehole"],
    "de": ["bohrprofil", "bohrlochprofil", "bohrung"],
    "fr": ["forage", "sondage"],
    "it": ["profilo di perforazione", "perforazione", "sondaggio"],
}
TITLE = {"en": ["project", "report"], "de": ["projekt", "bericht"], "fr": ["projet", "rapport"], "it": ["rapporto", "progetto"]}
GEO = {
    "en": ["geological cross-section", "geological section", "geological profile", "cross-section", "vertical section"],
    "de": ["längsprofil", "längenprofil", "geologischer schnitt", "geologisches profil", "vertikalschnitt"],
    "fr": ["coupe géologique", "profil géologique", "section géologique", "coupe en profondeur", "coupe verticale", "coupe longitudinale"],
    "it": ["sezione geologica", "profilo geologico", "sezione verticale", "taglio geologico"],
}
# fixed values: keyword groups of captions
CAPTION = {
    "en": [["profile", "log", "lithostratigraphy"], ["borehole", "drilling", "bore"]],
    "de": [["profil", "log", "lithostratigraphie"], ["bohrung", "bohrloch", "bohr"]],
    "fr": [["profil", "log", "lithostratigraphique"], ["forage", "sondage"]],
    "it": [["profilo", "log", "stratigrafico", "diagramma"], ["perforazione", "sondaggio"]],
}
# fixed values: front-page templates; a group is hit by any of its alternatives; the office before ", Geologische Informationsstelle" may be any
_COVER, _SHEET = ["PAGE DE GARDE", "P A G E DE G A R D E"], ["BELEGBLATT", "B E L E G B L A T T"]
FRONT_PAGES = [
    [_COVER, ["No AGS"], ["numéro ou signe"], ["distinctif original"], ["Commettants"], ["Réseau km"]],
    [_COVER, ["Commettants"], ["Renseignements"], ["(composition du"], ["Carte référence"], ["et carroyage"], ["des mots-clés"], ["Lieu de dépôt"], ["Disponibilité"], ["date limite"], ["Numéro AGS"]],
    [_COVER, ["No AGS"], ["numéro ou autre"], ["signe distinctif"], ["original du"], ["Commettants"], ["Réseau km"]],
    [_SHEET, ["SGD-Nr"], ["Originalkennzeichen"], ["des Dokumentes"], ["Km-Netz"], ["Kartenblatt"], ["Auftraggeber"], ["oder Rechts"], ["nachfolger"]],
    [_SHEET, ["SGD-Nr"], ["Originalkenn"], ["zeichen des"], ["Dokumentes"], ["Km-Netz"], ["Kartenblatt"], ["Auftraggeber"]],
    [_SHEET, ["SGD-Nr"], ["Originalnummer"], ["kennzeichen"], ["des Dokumentes"], ["Km-Netz"], ["Kartenblatt"], ["Auftraggeber"]],
    [["Auszug aus dem Titelverzeichnis"], ["Sortierung nach:"], ["Unser Zeichen:"], ["InfoGeol-Nr."], ["Metatitel"], ["Dokumentenzusammensetzung"]],
    [["Auszug aus dem Titelverzeichnis"], ["Sortierung nach:"], ["Unser Zeichen:"], ["InfoGeol-Nr."], ["Fläche"], ["Chronostratigraphie"], ["Tektonische Einheit"], ["Lithologie"], ["Aufschlussart"], ["Hydrologie"], [", Geologische Informationsstelle"]],
    [["DETAILBILD DER DOKU", "D E T A I L B I L D"], ["Z-SETZ"], ["SGM-DZ"], ["BERICHTE"], ["TABELLEN"], ["NOTIZEN"], ["DIAGRAMME"], ["SEITEN"], ["BEILAGEN"]],
    [["SGS-DOKUMENTNUMMER"], ["AUTOREN"], ["AUFTRAGGEBER oder HERAUSGEBER"], ["ZUSAMMENSETZUNG DES DOKUMENTES"], ["DATUM"], ["STANDORT"], ["VERFUEGBARKEIT"], ["NATIONALKARTENBLATT"], ["STICHWOERTER"]],
]
# fixed values: headings of tables of contents
CONTENTS = {
    "en": ["table of contents", "contents", "index", "overview", "summary", "list of topics"],
    "de": ["inhalt", "inhaltsverzeichnis", "übersicht", "index", "zusammenfassung", "kapitelübersicht"],
    "fr": ["table des matières", "sommaire", "index", "aperçu", "résumé"],
    "it": ["liste des chapitres", "contenuto", "indice dei contenuti", "panoramica", "indice", "sommario", "panoramica dei capitoli"],
}
# fixed values: pages kept of each class when a report is sampled
SAMPLE_CAPS = {"text": 1, "boreprofile": 2, "map": 2, "title_page": 2, "unknown": 5, "geo_profile": 5, "table": 5, "diagram": 5}
# frequent function words for the built-in language scorer; a trained model may take its place
STOP_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "für", "sich", "ein", "eine", "von", "mit"],
    "en": ["the", "and", "of", "to", "in", "is", "that", "for", "with", "on", "are", "was"],
    "es": ["el", "los", "las", "por", "con", "una", "del", "para", "como", "más", "pero", "sus"],
    "fr": ["le", "les", "des", "et", "dans", "qui", "pour", "pas", "sur", "au", "du", "est"],
    "it": ["il", "di", "che", "non", "per", "della", "gli", "sono", "nel", "dei", "alla", "anche"],
}
