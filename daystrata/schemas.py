"""Explicit schemas.  Nothing in the package infers a schema from data."""

from __future__ import annotations

RAW_COLUMNS = ("filename", "raw_json")
RAW_DOCUMENT = "filename string, raw_json string"

# The five daily metrics, which are also the file name prefixes.
METRICS = ("steps", "sleep", "stress", "body_battery", "heart_rate")

# Documents are read with string leaves, so that a number sent as text is still accepted and a
# nested value where a scalar is expected ends as NULL in the later try_cast.
ARRAY_DOCUMENT = "array<struct<steps:string,primaryActivityLevel:string,charged:string,drained:string>>"
OBJECT_DOCUMENT = (
    "struct<restingHeartRate:string,maxHeartRate:string,minHeartRate:string,"
    "lastSevenDaysAvgRestingHeartRate:string,avgStressLevel:string,maxStressLevel:string,"
    "dailySleepDTO:struct<sleepTimeSeconds:string,deepSleepSeconds:string,lightSleepSeconds:string,"
    "remSleepSeconds:string,awakeSleepSeconds:string>,bodyBatteryChange:string,avgOvernightHrv:string>"
)

STEPS_COLUMNS = ("steps", "steps_raw", "max_activity_level", "data_quality")
BODY_BATTERY_COLUMNS = ("charged", "drained", "net_battery")
HEART_RATE_COLUMNS = ("resting_hr", "max_hr", "min_hr", "avg_resting_hr_7d")
STRESS_COLUMNS = ("avg_stress", "max_stress", "stress_category")
SLEEP_COLUMNS = (
    "sleep_hours", "deep_sleep_hours", "light_sleep_hours", "rem_sleep_hours", "awake_hours",
    "sleep_body_battery_change", "sleep_resting_hr", "avg_overnight_hrv",
)
DAILY_COLUMNS = (
    "steps", "steps_quality", "charged", "drained", "net_battery", "resting_hr", "max_hr", "min_hr",
    "avg_resting_hr_7d", "avg_stress", "max_stress", "stress_category", "sleep_hours",
    "deep_sleep_hours", "rem_sleep_hours", "sleep_body_battery_change", "avg_overnight_hrv",
    "has_steps_data",
)

_TYPE_KEY = "struct<typeId:bigint,typeKey:string,parentTypeId:bigint,isHidden:boolean,restricted:boolean,trimmable:boolean>"
_SPLIT = (
    "struct<splitType:string,noOfSplits:bigint,totalExerciseReps:bigint,duration:double,"
    "movingDuration:double,distance:double,calories:double,bmrCalories:double,averageSpeed:double,"
    "maxSpeed:double,averageHR:double,maxHR:double,averagePower:double,maxPower:double,"
    "normalizedPower:double,averageRunCadence:double,maxRunCadence:double,averageTemperature:double,"
    "maxTemperature:double,minTemperature:double,averageMovingSpeed:double,elevationGain:double,"
    "elevationLoss:double,averageElevationGain:double,maxElevationGain:double,avgVerticalSpeed:double,"
    "groundContactTime:double,strideLength:double,avgStepLength:double,avgStepFrequency:double,"
    "verticalOscillation:double,verticalRatio:double,avgGradeAdjustedSpeed:double,avgStress:double,"
    "maxStress:double,maxDistance:bigint,maxDistanceWithPrecision:double>"
)
_SUMMARY = (
    "struct<startTimeLocal:string,startTimeGMT:string,duration:double,elapsedDuration:double,"
    "movingDuration:double,distance:double,averageSpeed:double,averageMovingSpeed:double,"
    "maxSpeed:double,calories:double,bmrCalories:double,averageHR:double,maxHR:double,minHR:double,"
    "averageTemperature:double,maxTemperature:double,minTemperature:double,averageRunCadence:double,"
    "maxRunCadence:double,elevationGain:double,elevationLoss:double,maxElevation:double,"
    "minElevation:double,maxVerticalSpeed:double,averagePower:double,maxPower:double,minPower:double,"
    "normalizedPower:double,totalWork:double,groundContactTime:double,strideLength:double,"
    "verticalOscillation:double,verticalRatio:double,avgGradeAdjustedSpeed:double,"
    "trainingEffect:double,anaerobicTrainingEffect:double,trainingEffectLabel:string,"
    "aerobicTrainingEffectMessage:string,anaerobicTrainingEffectMessage:string,"
    "minActivityLapDuration:double,waterEstimated:double,differenceBodyBattery:bigint,"
    "moderateIntensityMinutes:bigint,vigorousIntensityMinutes:bigint,steps:bigint,activeSets:bigint,"
    "directWorkoutFeel:bigint,directWorkoutRpe:bigint,avgStress:double,startStress:double,"
    "endStress:double,differenceStress:double,maxStress:double,avgRespirationRate:double,"
    "minRespirationRate:double,maxRespirationRate:double>"
)
_METADATA = (
    "struct<isOriginal:boolean,lapCount:bigint,lastUpdateDate:string,uploadedDate:string,"
    "manufacturer:string,hasPolyline:boolean,hasChartData:boolean,hasHrTimeInZones:boolean,"
    "hasPowerTimeInZones:boolean,hasSplits:boolean,hasHeatMap:boolean,hasIntensityIntervals:boolean,"
    "favorite:boolean,personalRecord:boolean,manualActivity:boolean,trimmed:boolean,"
    "elevationCorrected:boolean,autoCalcCalories:boolean,gcj02:boolean,associatedWorkoutId:bigint,"
    "trainingPlanId:bigint,specializedWorkoutCategories:array<string>,"
    "fileFormat:struct<formatId:bigint,formatKey:string>,"
    "deviceMetaDataDTO:struct<deviceId:string,deviceTypePk:bigint,deviceVersionPk:bigint>>"
)

# One activity.  Personal fields (names, coordinates) are left out, so they are never read.
ACTIVITY = (
    f"activityId bigint, activityName string, activityUUID struct<uuid:string>, "
    f"isMultiSportParent boolean, activityTypeDTO {_TYPE_KEY}, activityType {_TYPE_KEY}, "
    f"eventTypeDTO struct<typeId:bigint,typeKey:string,sortOrder:bigint>, "
    f"accessControlRuleDTO struct<typeId:bigint,typeKey:string>, "
    f"timeZoneUnitDTO struct<unitId:bigint,unitKey:string,factor:double,timeZone:string>, "
    f"metadataDTO {_METADATA}, summaryDTO {_SUMMARY}, splitSummaries array<{_SPLIT}>, "
    f"startTimeLocal string"
)
