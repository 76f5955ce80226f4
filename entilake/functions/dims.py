"""Languages, sites, datatypes and vocabulary as expressions and small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entilake.functions.text import string_literal

#: Language codes whose tag differs from the code.
LANGUAGE_TAGS = {
    "als": "gsw", "bat-smg": "sgs", "be-tarask": "be-tarask", "be-x-old": "be-tarask", "cbk-zam": "cbk-x-zam", "crh": "crh-Latn", "crh-latn": "crh-Latn",
    "de-at": "de-AT", "de-ch": "de-CH", "de-formal": "de-x-formal", "en-ca": "en-CA", "en-gb": "en-GB", "fiu-vro": "vro",
    "gan-hans": "gan-Hans", "gan-hant": "gan-Hant", "ike-cans": "ike-Cans", "ike-latn": "ike-Latn", "kk-arab": "kk-Arab",
    "kk-cn": "kk-CN", "kk-cyrl": "kk-Cyrl", "kk-kz": "kk-KZ", "kk-latn": "kk-Latn", "kk-tr": "kk-TR", "ksh": "mis-x-rip",
    "ku-arab": "ku-Arab", "ku-latn": "ku-Latn", "map-bms": "jv-x-bms", "nds-nl": "nds-NL", "nl-informal": "nl-x-informal",
    "nrm": "fr-x-nrm", "pt-br": "pt-BR", "roa-rup": "rup", "roa-tara": "it-x-tara", "simple": "en-x-simple", "sr-ec": "sr-Cyrl",
    "sr-el": "sr-Latn", "tg-latn": "tg-Latn", "tokipona": "mis-x-tokipona", "zh-classical": "lzh", "zh-cn": "zh-CN",
    "zh-hans": "zh-Hans", "zh-hant": "zh-Hant", "zh-hk": "zh-HK", "zh-min-nan": "nan", "zh-mo": "zh-MO", "zh-my": "zh-MY",
    "zh-sg": "zh-SG", "zh-tw": "zh-TW", "zh-yue": "yue",
}
#: Sites whose language is not that of their code.
SITE_TAGS = {"nowiki": "nb", "simplewiki": "en"}
#: Codes of three letters that are their own tags.
OWN_TAGS = (
    "ace aln ang arc arz ast avk bar bcl bjn bpy bug bxr cdo ceb chr chy ckb csb diq dsb egl eml ext frc frp frr fur gag gan glk got gsw "
    "hak haw hif hsb ilo jam jbo jut kaa kab kbd kiu koi krc krj lad lbe lez lfn lij liv lmo ltg lzh mdf mhr min mrj mwl myv mzn nah nan "
    "nap nds new nov nso pag pam pap pcd pdc pfl pih pms pnb pnt rmy rue rup sah scn sco sgs shi sma srn stq szl tet tpi tum tyv udm vec "
    "vep vls vmf vro war wuu xal xmf yue zea"
).split()
#: Of the codes of two letters that ISO 639 has or had, those without a tag; and three that newer lists left out.
NO_TAGS = "aa ae hz ii in iw ji kj kr lu mh nd nr oj".split()
OLD_TAGS = "bh mo sh".split()
#: The language part of a site's name: two or three letters, but not one of the codes reserved for private use (qaa to qtz).
SITE_CODE = r"^(?!q[a-t][a-z]$)[a-z]{2,3}$"

#: Datatype of a snak by its value type, and the datatypes a property may declare with their individuals.
TYPE_OF_VALUE = {"wikibase-entityid": "wikibase-item", "string": "string", "time": "time", "globecoordinate": "globe-coordinate", "quantity": "quantity"}
TYPE_INDIVIDUALS = {
    "wikibase-item": "wo:propertyTypeItem", "string": "wo:propertyTypeString", "commonsMedia": "wo:propertyTypeCommonsMedia",
    "time": "wo:propertyTypeTime", "globe-coordinate": "wo:propertyTypeGlobeCoordinates", "quantity": "wo:propertyTypeQuantity",
    "url": "wo:propertyTypeUrl",
}

#: The system vocabulary by kind of term, each with its label and comment.
VOCABULARY = {
    "o:Class": {
        "Entity": ("item", "The class of Wikibase entities."),
        "Item": ("item", "The class of Wikibase items."),
        "Property": ("item", "The class of Wikibase properties."),
        "Statement": ("statement", "The class of (reified) statements."),
        "Reference": ("reference", "The class of (reified) references."),
        "Datatype": ("datatype", "The class of Wikibase datatypes."),
        "GlobeCoordinatesValue": ("coordinates datavalue", "The class of (reified) coordinates datavalues."),
        "TimeValue": ("time datavalue", "The class of (reified) time datavalues."),
        "QuantityValue": ("quantity datavalue", "The class of (reified) quantity datavalues."),
    },
    "o:ObjectProperty": {
        "propertyType": ("property type", "This property specifies the Wikibase Datatype of a Wikibase Property."),
        "globe": ("globe", "This property specifies the globe (e.g., Q20/Earth) of a coordinates datavalue."),
        "preferredCalendar": ("preferred calendar model", "This property specifies the preferred calendar to be used for displaying a time datavalue."),
    },
    "o:DatatypeProperty": {
        "latitude": ("latitude", "This property specifies the latitude of a coordinates datavalue."),
        "longitude": ("longitude", "This property specifies the longitude of a coordinates datavalue."),
        "altitude": ("altitude", "This property specifies the optional altitude of a coordinates datavalue."),
        "gcPrecision": ("precision", "This property specifies the precision of a coordinates datavalue as a maximal distance from the given location."),
        "time": ("time", "This property specifies the time point (in the Gregorian calendar) of a time datavalue. It can use values of type XML Schema dateTime, date, gYearMonth, or gYear depending on precision."),
        "timePrecision": ("precision", "This property specifies the precision of a time datavalue as an integer. The meaning of values is: 11 (day), 10 (month), 9 (year), 8 (decade), ..., 1 (10^8 years), 0 (10^9 years)"),
        "numericValue": ("numeric value", "This property specifies the main numeric value of a quantity as an XML Schema decimal."),
        "lowerBound": ("lower bound", "This property specifies a lower bound for the numeric value of a quantity as an XML Schema decimal."),
        "upperBound": ("upper bound", "This property specifies an upper bound for the numeric value of a quantity as an XML Schema decimal."),
    },
    "wo:Datatype": {
        "propertyTypeItem": ("item", 'The "item" datatype of Wikibase properties.'),
        "propertyTypeString": ("string", 'The "string" datatype of Wikibase properties.'),
        "propertyTypeCommonsMedia": ("Commons media file", 'The "Commons media file" datatype of Wikibase properties.'),
        "propertyTypeTime": ("time", 'The "time" datatype of Wikibase properties.'),
        "propertyTypeGlobeCoordinates": ("geographic coordinates", 'The "geographic coordinates" datatype of Wikibase properties.'),
        "propertyTypeUrl": ("URL", 'The "URL" datatype of Wikibase properties.'),
        "propertyTypeQuantity": ("quantity", 'The "quantity" datatype of Wikibase properties.'),
    },
}
#: Classes with a class above them.
SUBCLASS_OF = {"Item": "wo:Entity", "Property": "wo:Entity"}


def literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def own_tags() -> list[str]:
    """Codes that are their own tags: those of ISO 639-1, as the JVM lists them, and OWN_TAGS."""
    iso = SparkSession.active()._jvm.java.util.Locale.getISOLanguages()
    return sorted({*iso, *OLD_TAGS, *OWN_TAGS} - {*NO_TAGS, *LANGUAGE_TAGS})


def language_tag(code: Column, known: list[str] | None = None) -> Column:
    """Tag of a language code, NULL for an unknown one. known: the codes that are their own tags, if not `own_tags`."""
    own = code.isin(*(own_tags() if known is None else known))
    return F.coalesce(F.try_element_at(literal_map(LANGUAGE_TAGS), code), F.when(own, code))


def site_prefix(site: Column) -> Column:
    """URL prefix of a site's pages; NULL for a site that is not understood."""
    part = lambda n: F.replace(site.substr(F.lit(1), F.length(site) - n), F.lit("_"), F.lit("-"))
    at = lambda n, host: F.concat(F.lit("http://"), part(n), F.lit(f".{host}.org/wiki/"))
    return F.when(site == "commonswiki", "http://commons.wikimedia.org/wiki/").when(site.endswith("wikivoyage"), at(10, "wikivoyage")).when(site.endswith("wiki"), at(4, "wikipedia"))


def site_language(site: Column) -> Column:
    """Language tag of a site; NULL for Commons and for sites of unknown languages."""
    code = F.replace(F.regexp_extract(site, r"^(.+?)(wikivoyage|wiki)$", 1), F.lit("_"), F.lit("-"))
    tag = F.coalesce(F.try_element_at(literal_map(SITE_TAGS), site), F.try_element_at(literal_map(LANGUAGE_TAGS), code), F.when(code.rlike(SITE_CODE), code))
    return F.when(site != "commonswiki", tag)


def property_range(datatype: Column) -> Column:
    """Range of a property: a literal type for strings, else things; also for unknown datatypes."""
    return F.when(datatype == "string", "x:string").otherwise("o:Thing")


def canonical_datatype(datatype: Column) -> Column:
    """A datatype as the model spells it, read without letter case and outer blanks; NULL for any other."""
    return F.try_element_at(literal_map({t.lower(): t for t in TYPE_INDIVIDUALS}), F.lower(F.trim(datatype)))


def vocabulary(spark: SparkSession) -> DataFrame:
    """(term, kind, label, comment, subclass_of) of the system vocabulary with the datatype individuals."""
    rows = [(f"wo:{t}", kind, label, comment, SUBCLASS_OF.get(t)) for kind, terms in VOCABULARY.items() for t, (label, comment) in terms.items()]
    return spark.createDataFrame(rows, "term string, kind string, label string, comment string, subclass_of string")


def vocabulary_triples(spark: SparkSession) -> DataFrame:
    """(s, p, o) of the vocabulary, as the export writes triples."""
    facts = F.array(*[F.struct(F.lit(p).alias("p"), o.alias("o")) for p, o in (("a", F.col("kind")), ("rs:label", string_literal(F.col("label"))), ("rs:comment", string_literal(F.col("comment"))), ("rs:subClassOf", F.col("subclass_of")))])
    return vocabulary(spark).select(F.col("term").alias("s"), F.explode(facts).alias("f")).where("f.o is not null").select("s", "f.*")
