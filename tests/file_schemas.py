"""Schemas of further report files, for tests."""

# Column names and types of the input files.
TAXI_ZONES = "LocationID INT, Borough STRING, Zone STRING, ServiceZone STRING"

YELLOW_TAXI = """
    VendorId INT, lpep_pickup_datetime TIMESTAMP, lpep_dropoff_datetime TIMESTAMP,
    passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID DOUBLE, store_and_fwd_flag STRING,
    PULocationID INT, DOLocationID INT, payment_type INT, fare_amount DOUBLE, extra DOUBLE,
    mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE,
    total_amount DOUBLE, congestion_surcharge DOUBLE, airport_fee DOUBLE
"""

FIRE_CALLS = """
    CallNumber INT, UnitID STRING, IncidentNumber INT, CallType STRING, CallDate STRING,
    WatchDate STRING, CallFinalDisposition STRING, AvailableDtTm STRING, Address STRING,
    City STRING, Zipcode INT, Battalion STRING, StationArea STRING, Box STRING,
    OriginalPriority INT, Priority INT, FinalPriority INT, ALSUnit BOOLEAN, CallTypeGroup STRING,
    NumAlarms INT, UnitType STRING, UnitSequenceInCallDispatch INT, FirePreventionDistrict STRING,
    SupervisorDistrict STRING, Neighborhood STRING, Location STRING, RowID STRING, Delay DOUBLE
"""

TAXI_BASES = """
    `License Number` STRING, `Entity Name` STRING, `Telephone Number` BIGINT,
    `SHL Endorsed` STRING, `Type of Base` STRING,
    Address STRUCT<Building: STRING, Street: STRING, City: STRING, State: STRING, Postcode: STRING>,
    GeoLocation STRUCT<Latitude: STRING, Longitude: STRING, Location: STRING>
"""
