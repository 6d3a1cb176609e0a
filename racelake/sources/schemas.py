"""Explicit schemas of the landing JSON pages (never inferred).

Results-feed pages wrap every list in ``MRData.<Table>.<List>`` and carry
scalars as strings; timing-feed pages are flat arrays of typed objects.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()


def st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def arr(t) -> T.ArrayType:
    return T.ArrayType(t, True)


def envelope(table: str, lst: str, item: T.DataType, extra=()) -> T.StructType:
    return st(("MRData", st(("total", S), (table, st(*extra, (lst, arr(item)))))))


DRIVER_REF = st(("driverId", S))
CONSTRUCTOR_REF = st(("constructorId", S))

SEASON = st(("season", S), ("url", S))
CIRCUIT = st(("circuitId", S), ("url", S), ("circuitName", S),
             ("Location", st(("lat", S), ("long", S), ("locality", S), ("country", S), ("alt", S))),
             ("length", S), ("turns", S))
CONSTRUCTOR = st(("constructorId", S), ("url", S), ("name", S), ("nationality", S))
DRIVER = st(("driverId", S), ("url", S), ("givenName", S), ("familyName", S), ("dateOfBirth", S),
            ("nationality", S), ("permanentNumber", S), ("code", S))
RESULT = st(("number", S), ("position", S), ("positionText", S), ("positionOrder", S), ("points", S),
            ("Driver", DRIVER_REF), ("Constructor", CONSTRUCTOR_REF), ("grid", S), ("laps", S), ("status", S),
            ("Time", st(("millis", S), ("time", S))),
            ("FastestLap", st(("rank", S), ("lap", S), ("Time", st(("time", S))), ("AverageSpeed", st(("speed", S))))))
QUALI = st(("number", S), ("position", S), ("Driver", DRIVER_REF), ("Constructor", CONSTRUCTOR_REF),
           ("Q1", S), ("Q2", S), ("Q3", S))
TIMING = st(("driverId", S), ("position", S), ("time", S))
LAP = st(("number", S), ("Timings", arr(TIMING)))
PITSTOP = st(("driverId", S), ("lap", S), ("stop", S), ("time", S), ("duration", S))
RACE = st(("season", S), ("round", S), ("url", S), ("raceName", S), ("Circuit", st(("circuitId", S))), ("date", S), ("time", S),
    ("Results", arr(RESULT)), ("QualifyingResults", arr(QUALI)), ("SprintResults", arr(RESULT)),
    ("Laps", arr(LAP)), ("PitStops", arr(PITSTOP)))
DRIVER_STANDING = st(("position", S), ("positionText", S), ("points", S), ("wins", S), ("Driver", DRIVER_REF),
                     ("Constructors", arr(CONSTRUCTOR_REF)))
CONSTRUCTOR_STANDING = st(("position", S), ("positionText", S), ("points", S), ("wins", S),
                          ("Constructor", CONSTRUCTOR_REF))
STANDINGS_LIST = st(("season", S), ("round", S), ("DriverStandings", arr(DRIVER_STANDING)),
                    ("ConstructorStandings", arr(CONSTRUCTOR_STANDING)))

SEASONS_PAGE = envelope("SeasonTable", "Seasons", SEASON)
CIRCUITS_PAGE = envelope("CircuitTable", "Circuits", CIRCUIT)
CONSTRUCTORS_PAGE = envelope("ConstructorTable", "Constructors", CONSTRUCTOR)
DRIVERS_PAGE = envelope("DriverTable", "Drivers", DRIVER, extra=(("season", S),))
RACES_PAGE = envelope("RaceTable", "Races", RACE, extra=(("season", S),))
STANDINGS_PAGE = envelope("StandingsTable", "StandingsLists", STANDINGS_LIST, extra=(("season", S),))

# timing feed: flat arrays, typed values
I = T.IntegerType()
OF1_SESSION = st(("session_key", L), ("session_name", S), ("session_type", S), ("status", S), ("gmt_offset", S),
                 ("path", S), ("date_start", S), ("date_end", S), ("year", I), ("circuit_key", I),
                 ("circuit_short_name", S), ("country_key", I), ("country_code", S), ("country_name", S),
                 ("location", S), ("meeting_key", L))
OF1_DRIVER = st(("session_key", L), ("driver_number", I), ("broadcast_name", S), ("full_name", S),
                ("name_acronym", S), ("team_name", S), ("team_colour", S), ("first_name", S), ("last_name", S),
                ("headshot_url", S), ("country_code", S))
OF1_LAP = st(("session_key", L), ("driver_number", I), ("lap_number", I), ("date_start", S), ("lap_duration", D),
             ("is_pit_out_lap", B), ("duration_sector_1", D), ("duration_sector_2", D), ("duration_sector_3", D),
             ("i1_speed", I), ("i2_speed", I), ("st_speed", I),
             ("segments_sector_1", arr(I)), ("segments_sector_2", arr(I)), ("segments_sector_3", arr(I)))
OF1_PIT = st(("session_key", L), ("driver_number", I), ("lap_number", I), ("date", S), ("pit_duration", D))
OF1_STINT = st(("session_key", L), ("driver_number", I), ("stint_number", I), ("lap_start", I), ("lap_end", I),
               ("compound", S), ("tyre_age_at_start", I))
OF1_INTERVAL = st(("session_key", L), ("driver_number", I), ("date", S), ("gap_to_leader", S), ("interval", S))
OF1_WEATHER = st(("session_key", L), ("date", S), ("air_temperature", D), ("track_temperature", D),
                 ("humidity", D), ("pressure", D), ("wind_direction", I), ("wind_speed", D), ("rainfall", B))
OF1_RACE_CONTROL = st(("session_key", L), ("date", S), ("driver_number", I), ("lap_number", I), ("category", S),
                      ("flag", S), ("scope", S), ("sector", I), ("message", S))
OF1_CAR = st(("session_key", L), ("driver_number", I), ("date", S), ("rpm", I), ("speed", I), ("n_gear", I),
             ("throttle", I), ("brake", I), ("drs", I))
OF1_LOCATION = st(("session_key", L), ("driver_number", I), ("date", S), ("x", I), ("y", I), ("z", I))
