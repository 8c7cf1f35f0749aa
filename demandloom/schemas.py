"""Column contracts, in one place."""

from pyspark.sql import types as T


BIGINT, INT, DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
STRING, DATE, BOOLEAN = T.StringType(), T.DateType(), T.BooleanType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SALES = struct(
    id=BIGINT, date=DATE, store_nbr=INT, family=STRING, sales=DOUBLE, onpromotion=BIGINT
)
REQUEST = struct(id=BIGINT, date=DATE, store_nbr=INT, family=STRING, onpromotion=BIGINT)
OIL = struct(date=DATE, dcoilwtico=DOUBLE)
HOLIDAYS = struct(
    date=DATE, type=STRING, locale=STRING, locale_name=STRING, description=STRING,
    transferred=BOOLEAN,
)
PROPORTIONS = struct(store_nbr=INT, family=STRING, proportion=DOUBLE)
INSTANCE = struct(
    id=BIGINT, date=DATE, store_nbr=INT, family=STRING, onpromotion=DOUBLE,
    oil_price=DOUBLE, is_holiday=DOUBLE, day_of_week=INT,
)

# The 16 measured features of the bean table, then its label.
BEAN_FEATURES = [
    "Area", "Perimeter", "MajorAxisLength", "MinorAxisLength", "AspectRation", "Eccentricity",
    "ConvexArea", "EquivDiameter", "Extent", "Solidity", "roundness", "Compactness",
    "ShapeFactor1", "ShapeFactor2", "ShapeFactor3", "ShapeFactor4",
]
BEAN_LABEL = "Class"
BEANS_UNLABELLED = struct(**dict.fromkeys(BEAN_FEATURES, DOUBLE))
BEANS = struct(**dict.fromkeys(BEAN_FEATURES, DOUBLE), **{BEAN_LABEL: STRING})

PAIR = ["store_nbr", "family"]
CALENDAR_EXOG = ["onpromotion", "oil_price", "is_holiday"]
EXOG = [*CALENDAR_EXOG, "day_of_week"]  # the order is a contract between fit and forecast
INSTANCE_COLS = INSTANCE.names
HORIZON = 15
SEASON = 7
