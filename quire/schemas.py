"""Schemas of the bibliographic tables.

Ids are longs: 32-bit ids widen without loss, and a large corpus has more than 2^31 edges and nodes.
Years and stored counters stay 32-bit.
"""

from pyspark.sql import types as T

ID = T.LongType()
STRINGS = T.ArrayType(T.StringType())
IDS = T.ArrayType(ID)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


EDGE = _struct(start_id=ID, end_id=ID)

ARTICLE_RAW = _struct(
    id=ID, key=T.StringType(), title=T.StringType(), ee=T.StringType(), ee_type=T.StringType(),
    mdate=T.StringType(), note=T.StringType(), url=T.StringType(), year=T.IntegerType(),
    number=T.StringType(), pages=T.StringType(), volume=T.StringType(),
)

EXTERNAL_AUTHOR = _struct(
    authorid=ID, externalids=T.StringType(), dblp=T.StringType(), orcid=T.StringType(),
    name=T.StringType(), aliases=T.StringType(), affiliations=T.StringType(),
    papercount=T.IntegerType(), citationcount=T.IntegerType(), hindex=T.IntegerType(),
    updated=T.StringType(), s2url=T.StringType(),
)

ARTICLE = _struct(
    ID=ID, part=T.IntegerType(), key=T.StringType(), title=T.StringType(), ee=STRINGS, ee_type=STRINGS,
    mdate=T.DateType(), note=STRINGS, url=STRINGS, year=T.IntegerType(), authors_ids=IDS, journal_id=ID,
    number=T.StringType(), pages=T.StringType(), volume=T.StringType(), citations=IDS, incoming_citations=IDS,
)

AUTHOR = _struct(
    ID=ID, part=T.IntegerType(), name=T.StringType(), affiliations=STRINGS, orcid=T.StringType(),
    hindex=T.IntegerType(), papercount=T.IntegerType(), citationcount=T.IntegerType(), written_articles_ids=IDS,
)

JOURNAL = _struct(
    journal_id=ID, part=T.IntegerType(), name=T.StringType(), NumArticles=ID, Articles=IDS,
)

PAPER = _struct(
    corpusid=ID, title=T.StringType(), abstract=T.StringType(), url=T.StringType(), venue=T.StringType(),
    year=T.IntegerType(), isopenaccess=T.BooleanType(), referencecount=T.LongType(),
    citationcount=T.LongType(), influentialcitationcount=T.LongType(), publicationdate=T.StringType(),
    updated=T.StringType(),
    externalids=_struct(DBLP=T.StringType(), MAG=T.StringType(), DOI=T.StringType()),
    authors=T.ArrayType(_struct(authorId=T.StringType(), name=T.StringType())),
    s2fieldsofstudy=T.ArrayType(_struct(category=T.StringType(), source=T.StringType())),
    publicationtypes=STRINGS,
    journal=_struct(name=T.StringType(), volume=T.StringType(), pages=T.StringType()),
)

REF_SPAN = _struct(start=T.IntegerType(), end=T.IntegerType(), text=T.StringType(), ref_id=T.StringType())

PAPER_TEXT = _struct(
    body_text=T.ArrayType(_struct(
        section=T.StringType(), text=T.StringType(),
        cite_spans=T.ArrayType(REF_SPAN), ref_spans=T.ArrayType(REF_SPAN))),
    ref_entries=T.MapType(T.StringType(), _struct(text=T.StringType(), type=T.StringType())),
)

IMAGE = _struct(
    idx=T.IntegerType(), author=T.StringType(), width=T.IntegerType(), height=T.IntegerType(),
    url=T.StringType(), download_url=T.StringType(),
)
