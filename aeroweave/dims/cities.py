"""The 79 German cities the feeds cover."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


class City(NamedTuple):
    city_key: str
    name: str
    lat: float
    lon: float
    official_name: str
    spellings: tuple[str, ...]


# Key, name, latitude, longitude, official name, spellings
CITIES: tuple[City, ...] = (
    City("berlin", "Berlin", 52.52, 13.405, "Berlin", ("Berlin",)),
    City("munich", "Munich", 48.1351, 11.582, "München", ("Munich", "München")),
    City("hamburg", "Hamburg", 53.5511, 10.0, "Hamburg", ("Hamburg",)),
    City("cologne", "Cologne", 50.9375, 6.9603, "Köln", ("Cologne", "Köln")),
    City("frankfurt", "Frankfurt am Main", 50.1109, 8.6821, "Frankfurt am Main", ("Frankfurt am Main", "Frankfurt")),
    City("stuttgart", "Stuttgart", 48.7758, 9.1829, "Stuttgart", ("Stuttgart",)),
    City("dusseldorf", "Düsseldorf", 51.2277, 6.7735, "Düsseldorf", ("Düsseldorf", "Dusseldorf")),
    City("dortmund", "Dortmund", 51.5136, 7.4653, "Dortmund", ("Dortmund",)),
    City("essen", "Essen", 51.4556, 7.0116, "Essen", ("Essen",)),
    City("leipzig", "Leipzig", 51.3397, 12.3731, "Leipzig", ("Leipzig",)),
    City("bremen", "Bremen", 53.0793, 8.8017, "Bremen", ("Bremen",)),
    City("dresden", "Dresden", 51.0504, 13.7373, "Dresden", ("Dresden",)),
    City("hanover", "Hanover", 52.3759, 9.732, "Hannover", ("Hanover", "Hannover")),
    City("nuremberg", "Nuremberg", 49.4521, 11.0767, "Nürnberg", ("Nuremberg", "Nürnberg")),
    City("duisburg", "Duisburg", 51.4344, 6.7623, "Duisburg", ("Duisburg",)),
    City("bochum", "Bochum", 51.4818, 7.2162, "Bochum", ("Bochum",)),
    City("wuppertal", "Wuppertal", 51.2562, 7.1508, "Wuppertal", ("Wuppertal",)),
    City("bielefeld", "Bielefeld", 52.02, 8.5325, "Bielefeld", ("Bielefeld",)),
    City("bonn", "Bonn", 50.7374, 7.0982, "Bonn", ("Bonn",)),
    City("munster", "Münster", 51.9607, 7.6261, "Münster", ("Münster", "Munster")),
    City("karlsruhe", "Karlsruhe", 49.0069, 8.4037, "Karlsruhe", ("Karlsruhe",)),
    City("mannheim", "Mannheim", 49.4875, 8.466, "Mannheim", ("Mannheim",)),
    City("augsburg", "Augsburg", 48.3668, 10.8987, "Augsburg", ("Augsburg",)),
    City("wiesbaden", "Wiesbaden", 50.0782, 8.2398, "Wiesbaden", ("Wiesbaden",)),
    City("gelsenkirchen", "Gelsenkirchen", 51.5177, 7.0857, "Gelsenkirchen", ("Gelsenkirchen",)),
    City("mönchengladbach", "Mönchengladbach", 51.1805, 6.4428, "Mönchengladbach", ("Mönchengladbach", "Moenchengladbach")),
    City("braunschweig", "Braunschweig", 52.2689, 10.5268, "Braunschweig", ("Braunschweig",)),
    City("chemnitz", "Chemnitz", 50.8278, 12.9214, "Chemnitz", ("Chemnitz",)),
    City("kiel", "Kiel", 54.3233, 10.1394, "Kiel", ("Kiel",)),
    City("aachen", "Aachen", 50.7753, 6.0839, "Aachen", ("Aachen",)),
    City("halle", "Halle", 51.4826, 11.9692, "Halle", ("Halle", "Halle (Saale)")),
    City("magdeburg", "Magdeburg", 52.1205, 11.6276, "Magdeburg", ("Magdeburg",)),
    City("freiburg", "Freiburg", 47.9978, 7.8427, "Freiburg", ("Freiburg", "Freiburg im Breisgau")),
    City("krefeld", "Krefeld", 51.3392, 6.5861, "Krefeld", ("Krefeld",)),
    City("lübeck", "Lübeck", 53.8655, 10.6866, "Lübeck", ("Lübeck", "Luebeck")),
    City("oberhausen", "Oberhausen", 51.473, 6.8807, "Oberhausen", ("Oberhausen",)),
    City("erfurt", "Erfurt", 50.9848, 11.0299, "Erfurt", ("Erfurt",)),
    City("mainz", "Mainz", 50.0012, 8.2763, "Mainz", ("Mainz",)),
    City("rostock", "Rostock", 54.0924, 12.0991, "Rostock", ("Rostock",)),
    City("kassel", "Kassel", 51.3127, 9.4797, "Kassel", ("Kassel",)),
    City("hagen", "Hagen", 51.3671, 7.4633, "Hagen", ("Hagen",)),
    City("hamm", "Hamm", 51.6739, 7.816, "Hamm", ("Hamm",)),
    City("saarbrücken", "Saarbrücken", 49.2402, 7.0097, "Saarbrücken", ("Saarbrücken", "Saarbruecken")),
    City("mülheim", "Mülheim an der Ruhr", 51.4314, 6.8807, "Mülheim an der Ruhr", ("Mülheim an der Ruhr", "Mülheim", "Muelheim")),
    City("potsdam", "Potsdam", 52.3906, 13.0645, "Potsdam", ("Potsdam",)),
    City("ludwigshafen", "Ludwigshafen", 49.4812, 8.4462, "Ludwigshafen", ("Ludwigshafen", "Ludwigshafen am Rhein")),
    City("oldenburg", "Oldenburg", 53.1435, 8.2146, "Oldenburg", ("Oldenburg",)),
    City("leverkusen", "Leverkusen", 51.0303, 6.9843, "Leverkusen", ("Leverkusen",)),
    City("osnabrück", "Osnabrück", 52.2799, 8.0472, "Osnabrück", ("Osnabrück", "Osnabrueck")),
    City("solingen", "Solingen", 51.1714, 7.0833, "Solingen", ("Solingen",)),
    City("heidelberg", "Heidelberg", 49.3988, 8.6724, "Heidelberg", ("Heidelberg",)),
    City("herne", "Herne", 51.5369, 7.226, "Herne", ("Herne",)),
    City("neuss", "Neuss", 51.2042, 6.6879, "Neuss", ("Neuss",)),
    City("darmstadt", "Darmstadt", 49.8728, 8.6512, "Darmstadt", ("Darmstadt", "DARMDTADT")),
    City("paderborn", "Paderborn", 51.7189, 8.757, "Paderborn", ("Paderborn",)),
    City("regensburg", "Regensburg", 49.0134, 12.1016, "Regensburg", ("Regensburg",)),
    City("ingolstadt", "Ingolstadt", 48.7665, 11.4258, "Ingolstadt", ("Ingolstadt",)),
    City("würzburg", "Würzburg", 49.7913, 9.9534, "Würzburg", ("Würzburg", "Wuerzburg")),
    City("fürth", "Fürth", 49.4771, 10.9887, "Fürth", ("Fürth", "Fuerth")),
    City("wolfsburg", "Wolfsburg", 52.4226, 10.7865, "Wolfsburg", ("Wolfsburg",)),
    City("offenbach", "Offenbach", 50.1036, 8.766, "Offenbach", ("Offenbach", "Offenbach am Main")),
    City("ulm", "Ulm", 48.4011, 9.9876, "Ulm", ("Ulm",)),
    City("heilbronn", "Heilbronn", 49.1427, 9.2109, "Heilbronn", ("Heilbronn",)),
    City("pforzheim", "Pforzheim", 48.8932, 8.6919, "Pforzheim", ("Pforzheim",)),
    City("göttingen", "Göttingen", 51.5413, 9.9158, "Göttingen", ("Göttingen", "Goettingen")),
    City("bottrop", "Bottrop", 51.5232, 6.9253, "Bottrop", ("Bottrop",)),
    City("trier", "Trier", 49.7499, 6.6371, "Trier", ("Trier",)),
    City("recklinghausen", "Recklinghausen", 51.6144, 7.1979, "Recklinghausen", ("Recklinghausen",)),
    City("reutlingen", "Reutlingen", 48.4914, 9.2115, "Reutlingen", ("Reutlingen",)),
    City("bremerhaven", "Bremerhaven", 53.5396, 8.5809, "Bremerhaven", ("Bremerhaven",)),
    City("koblenz", "Koblenz", 50.3569, 7.589, "Koblenz", ("Koblenz",)),
    City("bergisch_gladbach", "Bergisch Gladbach", 50.9916, 7.1233, "Bergisch Gladbach", ("Bergisch Gladbach",)),
    City("jena", "Jena", 50.9271, 11.5862, "Jena", ("Jena",)),
    City("remscheid", "Remscheid", 51.1784, 7.1997, "Remscheid", ("Remscheid",)),
    City("erlangen", "Erlangen", 49.5897, 11.0039, "Erlangen", ("Erlangen",)),
    City("moers", "Moers", 51.4514, 6.6314, "Moers", ("Moers", "MÖRS")),
    City("siegen", "Siegen", 50.875, 8.0167, "Siegen", ("Siegen",)),
    City("hildesheim", "Hildesheim", 52.1508, 9.9513, "Hildesheim", ("Hildesheim",)),
    City("salzgitter", "Salzgitter", 52.15, 10.3333, "Salzgitter", ("Salzgitter",)),
)


def dim_city(spark: SparkSession) -> DataFrame:
    """One row per city: key, name, spellings (given and upper case), position, official name."""
    columns = {
        "city_key": [c.city_key for c in CITIES],
        "name": [c.name for c in CITIES],
        "name_variations": [list(dict.fromkeys([*c.spellings, *(s.upper() for s in c.spellings)]))
                            for c in CITIES],
        "lat": [c.lat for c in CITIES],
        "lon": [c.lon for c in CITIES],
        "official_name": [c.official_name for c in CITIES],
    }
    return spark.createDataFrame(pa.table(columns))


def city_aliases() -> dict[str, str]:
    """Lower-case spelling to city key; a city's own key is a spelling too."""
    aliases: dict[str, str] = {}
    for city in CITIES:
        for spelling in (city.city_key, *city.spellings):
            aliases.setdefault(spelling.lower(), city.city_key)
    return aliases
