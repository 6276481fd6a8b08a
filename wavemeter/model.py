"""Table shapes. Event time is ``__time TIMESTAMP_NTZ``, read as UTC wall-clock time."""

from __future__ import annotations

from pyspark.sql import types as T

TIME = "__time"
MEASURES = ("value", "numerator", "denominator")

# Dimension names of the roll-up tables.
DIMENSIONS = (
    "managedObjectId",
    "additionalDn",
    "dn",
    "vendorId",
    "reportInterval",
    "equipmentTypeId",
    "equipmentId",
    "sourceSystem",
    "functionId",
    "locationId",
    "enrichment",
    "networkGroups",
    "pollingRuleId",
    "formulaId",
    "metricId",
    "isRate",
    "granularityInterval",
)

GROUP_DIMENSIONS = (
    "reportInterval",
    "formulaId",
    "metricId",
    "isRate",
    "granularityInterval",
    "networkGroup",
)

PARTIALS = ("count",) + tuple(f"{f}_{m}" for m in MEASURES for f in ("sum", "max", "min"))


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _D, _L, _I, _B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
_TS, _A = T.TimestampNTZType(), T.ArrayType(T.StringType())

METRICS = T.StructType(
    [
        T.StructField(TIME, _TS, False),
        *[
            T.StructField(n, _S)
            for n in (
                "dn", "additionalDn", "metricId", "formulaId", "pollingRuleId", "functionId",
                "managedObjectId", "equipmentId", "equipmentTypeId", "locationId", "vendorId",
                "sourceVendor", "sourceSystem", "elementType", "managerIp", "managerFilename",
                "category",
            )
        ],
        T.StructField("networkGroups", _A),
        T.StructField("enrichment", _S),
        T.StructField("isRate", _B),
        T.StructField("reportInterval", _I),
        T.StructField("granularityInterval", _S),
        T.StructField("value", _D),
        T.StructField("numerator", _D),
        T.StructField("denominator", _D),
    ]
)

COUNTERS = T.StructType(
    [
        T.StructField(TIME, _TS, False),
        *[
            T.StructField(n, _S)
            for n in (
                "additionalDn", "dn", "vendorName", "name", "code", "familyId", "elementType",
                "sourceSystem", "managerIp", "isReliable", "managerFilename",
            )
        ],
        T.StructField("reportInterval", _I),
        T.StructField("value", _D),
    ]
)

# One row per (threshold, KPI term).
THRESHOLDS = T.StructType(
    [
        *[
            T.StructField(n, _S)
            for n in (
                "node_id", "node_name", "dataAggregationTime", "dataAggregationTimeGranularity",
                "dataAggregationFunction",
            )
        ],
        T.StructField("dataAggregationPercentileValue", _D),
        *[T.StructField(n, _S) for n in ("spatialAggregation", "spatialAggregationFunction")],
        T.StructField("spatialAggregationPercentileValue", _D),
        *[
            T.StructField(n, _S)
            for n in (
                "spatialLocationTypeAggregation", "id_spatialManagedObjectAggregation",
                "managedObject_id", "managedObject_name", "dataTableName",
            )
        ],
        *[
            T.StructField(n, _A)
            for n in ("id_ngInclusion", "id_ngInclusion_SG", "typeAssociation", "equipmentInclusion")
        ],
        *[
            T.StructField(n, _S)
            for n in ("kpi_id", "kpi_name", "kpi_defaultTimeGranularity", "kpi_unit")
        ],
        T.StructField("kpi_isRate", _B),
        *[
            T.StructField(f"kpi_{n}", _S)
            for n in ("hourly", "daily", "weekly", "monthly", "yearly")
        ],
        *[
            T.StructField(f"{n}Percentile", _D)
            for n in ("hourly", "daily", "weekly", "monthly", "yearly")
        ],
        T.StructField("algorithm", _S),
        T.StructField("algorithmComparisonValue", _D),
        T.StructField("intervalDays", _I),
        T.StructField("times", _I),
        T.StructField("effectiveDays", _S),
        T.StructField("optionsDays", _A),
        T.StructField("effectiveHours", _A),
        T.StructField("load_status", _S),
        T.StructField("timeZone", _S),
    ]
)

_IDNAME = _struct(id=_S, name=_S)
_GROUP_REF = _struct(id=_S, name=_S, typeAssociation=_S)
_EQUIPMENT_REF = _struct(id=_S, dn=_S)

# Nested threshold document, as landed.
THRESHOLD_DOCUMENT = _struct(
    thresholds=_struct(
        edges=T.ArrayType(
            _struct(
                node=_struct(
                    id=_S, name=_S, status=_B, dataAggregationTime=_S,
                    dataAggregationTimeGranularity=_S, dataAggregationFunction=_S,
                    dataAggregationPercentileValue=_D, spatialAggregation=_S,
                    spatialAggregationFunction=_S, spatialAggregationPercentileValue=_D,
                    spatialLocationTypeAggregation=_IDNAME,
                    spatialManagedObjectAggregation=_IDNAME,
                    managedObject=_struct(id=_S, name=_S, model=_struct(tableName=_S)),
                    expression=_struct(
                        id=_S,
                        terms=T.ArrayType(
                            _struct(
                                kpi=_struct(
                                    id=_S, name=_S, defaultTimeGranularity=_S, isRate=_B, unit=_S,
                                    hourly=_S, daily=_S, weekly=_S, monthly=_S, yearly=_S,
                                    hourlyPercentile=_D, dailyPercentile=_D, weeklyPercentile=_D,
                                    monthlyPercentile=_D, yearlyPercentile=_D,
                                )
                            )
                        ),
                    ),
                    equipmentAssociation=T.ArrayType(
                        _struct(
                            ngInclusion=T.ArrayType(_GROUP_REF),
                            ngExclusion=T.ArrayType(_GROUP_REF),
                            equipmentInclusion=T.ArrayType(_EQUIPMENT_REF),
                            equipmentExclusion=T.ArrayType(_EQUIPMENT_REF),
                        )
                    ),
                    algorithm=_S, algorithmComparisonValue=_D, algorithmComparisonType=_S,
                    intervalDays=_I, times=_I, effectiveDays=_S,
                    days=T.ArrayType(_struct(optionsDays=_S)),
                    effectiveHours=T.ArrayType(_struct(optionsEffectiveHours=_S)),
                    timeZone=_S,
                )
            )
        )
    )
)

# Nested busy-hour document, as landed.
BUSY_HOUR_DOCUMENT = _struct(
    busyHours=_struct(
        edges=T.ArrayType(
            _struct(
                node=_struct(
                    id=_S, name=_S, description=_S, status=_S, aggregationFunction=_S,
                    percentileValue=_D,
                    kpi=_struct(id=_S, name=_S, status=_S, defaultTimeGranularity=_S),
                    managedObject=_struct(id=_S, name=_S, model=_struct(tableName=_S)),
                    timeSettings=T.ArrayType(
                        _struct(period=_S, firstBH=_B, secondBH=_B, thirdBH=_B)
                    ),
                    effectiveDay=_S,
                    days=T.ArrayType(_struct(day1=_S, day2=_S, day3=_S)),
                    effectiveHour=T.ArrayType(_struct(optionsEffectiveHours=_S)),
                    date=_S,
                )
            )
        )
    )
)

# Network-group children page used to expand super-groups.
GROUP_CHILDREN_DOCUMENT = _struct(
    networkGroups=_struct(
        edges=T.ArrayType(
            _struct(node=_struct(id=_S, name=_S, parentId=_S, targetGroups=T.ArrayType(_S)))
        )
    )
)

PROMQL_DOCUMENT = _struct(
    status=_S,
    data=_struct(
        resultType=_S,
        result=T.ArrayType(
            _struct(metric=T.MapType(_S, _S), value=T.ArrayType(_S)),
        ),
    ),
)

ALERT = _struct(
    alarmId=_S, alarmTypeName=_S, alarmedObjectName=_S, thresholdRuleName=_S, value=_S,
    alarmRaisedTime=_L, timeZone=_S, eventType=_S, perceivedSeverity=_S, cleared=_B,
    sendToEmail=_struct(list=T.ArrayType(_S)),
)

REPORT_REQUEST = _struct(storekey=_S, exportFormat=_S, recipients=_S)

ELEMENT_MESSAGE = T.StructType(
    [T.StructField(TIME, _TS)]
    + [
        T.StructField(n, _S)
        for n in ("additionalDn", "dn", "sourceSystem", "vendorName", "managerIp", "elementType")
    ]
)

COLLECTOR_STATE = _struct(device=_S, lastSeen=_TS, offlineHours=_D, status=_S, dt_load=_TS)
