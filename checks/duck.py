"""DuckDB SQL that computes every registered query a second time, from the same order data.

Bounds, weights and categories in the statements are fixed values of the rules, stated as the rules state them.
Quotients are rounded with integer arithmetic (see ``quotient``), because DuckDB divides decimals as doubles.
"""

from __future__ import annotations

from checks.columns import COLUMNS
from roamsight.sources.derived import CITIES

_TYPES = {"i": "BIGINT", "d": "DOUBLE", "b": "BOOLEAN", "s": "VARCHAR"}


def quotient(num: str, den: str, digits: int, num_scale: int = 0) -> str:
    """num / den rounded half away from zero as DECIMAL(18, digits); num is an integer scaled by 10^num_scale."""
    up, down = 10 ** max(digits - num_scale, 0), 10 ** max(num_scale - digits, 0)
    n, d = f"(({num})::HUGEINT * {up})", f"(({den})::HUGEINT * {down})"
    return (
        f"CASE WHEN ({den}) <> 0 THEN CAST(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d})))"
        f" AS DECIMAL(18,0)) * CAST(1e-{digits} AS DECIMAL({digits + 1},{digits})) END"
    )


# The place that stands for each nation.
_CITIES = ", ".join(
    "({}, '{}', '{}')".format(number, city.replace("'", "''"), country) for number, (city, country) in enumerate(CITIES)
)

_TABLES = {
    "places": """
        SELECT n_nationkey AS nk, city, country,
               concat('AP', n_nationkey) AS airport, (20 + n_nationkey)::DOUBLE AS lat,
               (4 * n_nationkey - 120)::DOUBLE AS lon
        FROM nation JOIN (VALUES """ + _CITIES + """) AS named(number, city, country) ON number = n_nationkey""",
    "buys": """
        SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS d, o_orderpriority AS prio,
               (k * 7919) % 10007 AS h1, (k * 104729) % 10009 AS h2, (k * 1299709) % 10037 AS h3, h1 % 5 IN (0, 1) AS trip
        FROM orders""",
    "sessions": """
        SELECT k + later * 1000000000 AS session_id, c AS user_id, if(trip, k, NULL) AS trip_id,
               d + to_days(later) + to_seconds(h2 % 86400) AS session_start,
               d + to_days(later) + to_seconds(h2 % 86400 + 60 + h3 % 3000) AS session_end,
               1 + h1 % 60 AS page_clicks,
               if(trip, prio <> '5-LOW', if(h2 % 3 = 0, NULL, false)) AS flight_booked,
               if(trip, prio <> '1-URGENT', if(h2 % 3 = 0, NULL, false)) AS hotel_booked,
               h1 % 3 = 0 AS flight_discount, h2 % 3 = 0 AS hotel_discount,
               if(h3 % 9 = 0, NULL, (h3 % 7 * 5)) AS off, later = 1 AS cancellation
        FROM buys JOIN (VALUES (0), (1)) AS visit(later) ON later = 0 OR (trip AND h3 % 10 = 0)""",
    "flights": """
        SELECT k AS trip_id, if(h1 % 17 = 0, 'ELSEWHERE', home.airport) AS origin_airport, goal.city AS destination,
               1 + h2 % 4 AS seats, h2 % 6 <> 0 AS return_flight_booked, d + to_days((7 + h3 % 60)::INT) AS departure_time,
               if(h2 % 6 <> 0, d + to_days((7 + h3 % 60 + 1 + h1 % 9)::INT), NULL) AS return_time,
               h3 % 3 AS checked_bags, concat('Air', h1 % 5) AS trip_airline, goal.lat AS to_lat, goal.lon AS to_lon,
               5000 + h2 * 13 % 90000 AS fare_cents
        FROM buys JOIN customer ON c = c_custkey JOIN places home ON home.nk = c_nationkey
             JOIN places goal ON goal.nk = h2 % 25
        WHERE trip AND prio <> '5-LOW' AND h3 % 50 <> 1""",
    "hotels": """
        SELECT k AS trip_id, concat('Brand', h1 % 9, if(h1 % 13 = 0, ' ', ' - '), city) AS hotel_name,
               h3 % 12 - 2 AS nights, 1 + h2 % 3 AS rooms,
               d + to_days((7 + h3 % 60)::INT) + to_hours(14) AS check_in_time,
               d + to_days((7 + h3 % 60 + greatest(h3 % 12 - 2, 1))::INT) + to_hours(14) AS check_out_time,
               40 + h1 % 400 AS room_usd
        FROM buys JOIN places ON nk = h2 % 25
        WHERE trip AND prio <> '1-URGENT' AND h3 % 50 <> 2""",
    "users": """
        SELECT c_custkey AS user_id,
               if(c_custkey % 97 = 0, NULL, DATE '1930-01-01' + (c_custkey * 7919 % 20000)::INT) AS birthdate,
               c_custkey % 3 = 0 AS married, c_custkey % 5 = 0 AS has_children, country AS home_country,
               airport AS home_airport, lat AS home_lat, lon AS home_lon,
               coalesce(if(c_custkey % 10 = 0, hi::DATE - 10, lo::DATE - (c_custkey % 40)::INT), DATE '1995-06-01')
                   AS sign_up_date
        FROM customer JOIN places ON nk = c_nationkey
             LEFT JOIN (SELECT c, min(d) AS lo, max(d) AS hi FROM buys GROUP BY c) ON c = c_custkey""",
}

_SESSION_STEPS = {
    "recent": "SELECT * FROM sessions WHERE session_start >= TIMESTAMP '1997-01-01'",
    "joined": """
        SELECT r.*, u.* EXCLUDE (user_id), f.* EXCLUDE (trip_id), h.* EXCLUDE (trip_id),
               p.country AS destination_country, off / 100.0 AS off_part, fare_cents / 100.0 AS base_fare_usd,
               room_usd AS hotel_per_room_usd
        FROM recent r
             JOIN users u ON u.user_id = r.user_id
             LEFT JOIN flights f ON f.trip_id = r.trip_id
             LEFT JOIN hotels h ON h.trip_id = r.trip_id
             LEFT JOIN places p ON p.city = f.destination AND p.nk <> 24
        WHERE (SELECT count(*) FROM recent x WHERE x.user_id = r.user_id) > 7""",
    "cleaned": """
        SELECT *, return_time::DATE - departure_time::DATE AS away,
               coalesce(flight_booked, false) AND trip_airline IS NOT NULL AS flight_booked_cleaned,
               coalesce(hotel_booked, false) AND hotel_name IS NOT NULL AS hotel_booked_cleaned,
               flight_discount AND off IS NOT NULL AS flight_discount_cleaned,
               hotel_discount AND off IS NOT NULL AS hotel_discount_cleaned,
               if(nights <= 0, if(return_time IS NOT NULL, return_time::DATE - check_in_time::DATE, greatest(-nights, 1)),
                  check_out_time::DATE - check_in_time::DATE) AS nights_cleaned,
               if(contains(hotel_name, '-'), trim(split_part(hotel_name, '-', -1)), NULL) AS hotel_city,
               (date_diff('microsecond', session_start, session_end) + 300000) // 600000 AS hundredths,
               hundredths * 0.01 AS session_duration_min,
               isodow(departure_time) AS departure_dow, isodow(return_time) AS return_dow,
               isodow(check_in_time) AS check_in_dow, greatest(away, 1) AS flight_trip_length,
               date_diff('year', birthdate, DATE '2001-12-31') AS age_years,
               power(sin(radians(to_lat - home_lat) / 2), 2) + cos(radians(home_lat)) * cos(radians(to_lat))
                   * power(sin(radians(to_lon - home_lon) / 2), 2) AS chord,
               if(origin_airport = home_airport, 12742 * asin(sqrt(least(1, chord))), NULL) AS km
        FROM joined""",
    "statuses": """
        SELECT trip_id, if(bool_or(cancellation), 'cancelled',
                           if(bool_or(flight_booked_cleaned OR hotel_booked_cleaned), 'booked', 'none')) AS trip_status
        FROM cleaned WHERE trip_id IS NOT NULL GROUP BY trip_id""",
    "base": f"""
        SELECT c.*, coalesce(s.trip_status, 'none') AS trip_status, trip_status = 'booked' AS ok,
               flight_booked_cleaned AS fl, hotel_booked_cleaned AS ho, km AS flight_distance_km,
               isodow(check_in_time::DATE + nights_cleaned::INT) AS dow_check_out_cleaned,
               CASE WHEN age_years < 26 THEN '18-25' WHEN age_years < 36 THEN '26-35' WHEN age_years < 46 THEN '36-45'
                    WHEN age_years < 56 THEN '46-55' WHEN age_years >= 56 THEN '55+' ELSE 'unknown' END AS age_group,
               if(fl, if(ho, 'flight+hotel', 'flight only'), if(ho, 'hotel only', 'browsing only')) AS booking_category,
               {quotient("page_clicks * 100", "hundredths", 2)} AS clicks_per_min,
               if(booking_category = 'hotel only', page_clicks, NULL) AS clicks_hotel_only,
               if(booking_category = 'flight only', page_clicks, NULL) AS clicks_flight_only,
               if(booking_category = 'flight+hotel', page_clicks, NULL) AS clicks_flight_hotel,
               if(booking_category = 'browsing only', page_clicks, NULL) AS clicks_browsing_only,
               clicks_browsing_only AS clicks_browsing,
               if(ok, page_clicks, NULL) AS clicks_booking,
               if(trip_status = 'cancelled', page_clicks, NULL) AS clicks_cancellation,
               if(ok, session_duration_min, NULL) AS session_duration_booking,
               if(trip_status = 'cancelled', session_duration_min, NULL) AS session_duration_cancellation,
               if(NOT (fl OR ho), session_duration_min, NULL) AS session_duration_browsing,
               if(ok AND fl AND ho, departure_time::DATE - session_start::DATE, NULL) AS leadtime_flight_hotel_combined,
               if(ok AND fl AND NOT ho, departure_time::DATE - session_start::DATE, NULL) AS leadtime_flight_only,
               if(ok AND ho AND NOT fl, check_in_time::DATE - session_start::DATE, NULL) AS leadtime_hotel_only,
               if(ho, if(nights_cleaned > 7, 'long (8+)', if(nights_cleaned > 3, 'mid (4-7)', 'short (1-3)')), NULL)
                   AS stay_length,
               if(fl AND return_flight_booked, away, NULL) AS flight_trip_nights,
               flight_trip_nights + 1 AS flight_trip_days,
               fl AND return_flight_booked AND departure_dow IN (5, 6) AND away BETWEEN 1 AND 2 AS is_weekender_flight,
               ho AND check_in_dow IN (5, 6) AND nights_cleaned BETWEEN 1 AND 2 AS is_weekender_hotel,
               fl AND return_flight_booked AND away <= 4 AND departure_dow NOT IN (6, 7) AND return_dow NOT IN (6, 7)
                   AND departure_dow < return_dow AS is_short_weekday_flight,
               ho AND nights_cleaned BETWEEN 1 AND 4 AND check_in_dow NOT IN (6, 7)
                   AND check_in_dow + nights_cleaned NOT IN (6, 7) AS is_short_weekday_hotel,
               if(ho, ['winter', 'spring', 'summer', 'fall'][month(check_in_time) % 12 // 3 + 1], NULL) AS season_hotel,
               if(fl, ['winter', 'spring', 'summer', 'fall'][month(departure_time) % 12 // 3 + 1], NULL) AS season_flight,
               if(km > 3500, 'long-haul', if(km > 1500, 'medium-haul', if(km >= 0, 'short-haul', NULL)))
                   AS flight_distance_category,
               if(km IS NULL, NULL, if(home_country = destination_country, 'domestic',
                  if(destination_country IN ('usa', 'canada', 'mexico'), 'international', 'intercontinental')))
                   AS flight_destination_category,
               if(fl, {quotient("fare_cents", "seats", 2, 2)}, NULL) AS flight_price_per_seat,
               if(fl AND km > 0, (fare_cents::DOUBLE / 100 / seats / (km * if(return_flight_booked, 2, 1)))::DECIMAL(18,4),
                  NULL) AS flight_price_per_km
        FROM cleaned c LEFT JOIN statuses s ON s.trip_id = c.trip_id""",
}

_USER_STEPS = {
    "totals": f"""
        SELECT user_id,
               sum(hundredths) AS h_all, sum(hundredths) FILTER (ok) AS h_book,
               sum(hundredths) FILTER (trip_status = 'cancelled') AS h_cancel,
               sum(hundredths) FILTER (booking_category = 'browsing only') AS h_browse,
               h_all / 100 AS total_min_sessions, h_book / 100 AS total_min_booking,
               h_cancel / 100 AS total_min_cancellation, h_browse / 100 AS total_min_browsing,
               sum(page_clicks) AS total_page_clicks, sum(clicks_booking) AS total_clicks_booking,
               sum(clicks_cancellation) AS total_clicks_cancellation, sum(clicks_browsing) AS total_clicks_browsing,
               count(*) AS total_sessions, count(*) - count(trip_id) AS total_browsing_only,
               count(DISTINCT trip_id) AS total_bookings, count(*) FILTER (cancellation) AS total_cancellations,
               total_bookings - total_cancellations AS valid_bookings,
               count(*) FILTER (ok AND fl AND ho) AS valid_combined_bookings,
               count(*) FILTER (ok AND fl) AS valid_flight_bookings,
               count(*) FILTER (ok AND fl AND NOT ho) AS flight_bookings_only,
               count(*) FILTER (ok AND ho) AS valid_hotel_bookings,
               count(*) FILTER (ok AND ho AND NOT fl) AS hotel_bookings_only,
               count(*) FILTER (ok AND fl AND flight_destination_category = 'domestic') AS domestic_flight_bookings,
               count(*) FILTER (ok AND fl AND flight_destination_category = 'international') AS international_flight_bookings,
               count(*) FILTER (ok AND fl AND flight_destination_category = 'intercontinental')
                   AS intercontinental_flight_bookings,
               count(*) FILTER (ok AND fl AND flight_discount_cleaned) AS discount_flight_bookings,
               {quotient("sum(off) FILTER (ok AND fl)", "count(off) FILTER (ok AND fl)", 4, 2)} AS avg_flight_discount,
               sum((flight_price_per_km * 10000)::BIGINT * (100 - coalesce(off, 0))) FILTER (ok AND fl) AS km_micros,
               km_micros / 1e6 AS sum_flight_price_per_km,
               count(*) FILTER (ok AND ho AND hotel_discount_cleaned) AS discount_hotel_bookings,
               {quotient("sum(off) FILTER (ok AND ho)", "count(off) FILTER (ok AND ho)", 4, 2)} AS avg_hotel_discount,
               sum(room_usd * (100 - coalesce(off, 0))) FILTER (ok AND ho) AS room_cents,
               room_cents / 100 AS sum_hotel_price_per_night,
               count(*) FILTER (ok AND ((fl AND flight_discount_cleaned) OR (ho AND hotel_discount_cleaned)))
                   AS sum_discount_bookings,
               sum(if(ok, seats, 0)) AS valid_seats, sum(if(ok, checked_bags, 0)) AS valid_bags,
               sum(if(ok, rooms, 0)) AS valid_rooms,
               count(*) FILTER (ok AND seats = 1) AS single_seat_bookings,
               count(*) FILTER (ok AND checked_bags = 0) AS no_bag_bookings,
               count(*) FILTER (ok AND rooms = 1) AS one_room_bookings,
               count(*) FILTER (ok AND fl AND ho AND rooms = 1 AND seats = 1) AS single_room_bookings,
               count(*) FILTER (ok AND fl AND ho AND rooms = 1 AND seats = 2) AS double_room_bookings,
               sum(if(ok AND fl AND ho, flight_trip_nights, 0)) AS nights_combined_flight_hotel,
               sum(if(ok AND fl, flight_trip_nights, 0)) AS nights_flight_total,
               sum(if(ok AND fl AND NOT ho, flight_trip_nights, 0)) AS nights_flight_only,
               sum(if(ok AND ho AND NOT fl, nights_cleaned, 0)) AS nights_hotel_only,
               count(*) FILTER (ok AND (is_short_weekday_flight OR is_short_weekday_hotel)) AS short_weekday_trips,
               count(*) FILTER (ok AND (is_weekender_flight OR is_weekender_hotel)) AS weekend_trips,
               sum(leadtime_flight_hotel_combined) AS sum_leadtime_flight_hotel,
               sum(leadtime_hotel_only) AS sum_leadtime_hotel_only, sum(leadtime_flight_only) AS sum_leadtime_flight_only,
               any_value(age_years) AS age, bool_or(married)::INT AS is_married, bool_or(has_children)::INT AS has_children,
               max(session_start::DATE) FILTER (ok) - any_value(sign_up_date) AS last_booking_since_signup,
               max(session_start::DATE) - any_value(sign_up_date) AS last_session_since_signup
        FROM base GROUP BY user_id""",
    "averages": "SELECT *, "
    + ", ".join(
        f"{quotient(num, den, 4, scale)} AS {name}"
        for name, num, den, scale in [
            ("avg_min_per_session", "h_all", "total_sessions", 2),
            ("avg_min_booking", "h_book", "valid_bookings", 2),
            ("avg_min_cancellation", "h_cancel", "total_cancellations", 2),
            ("avg_min_browsing", "h_browse", "total_browsing_only", 2),
            ("avg_page_clicks", "total_page_clicks", "total_sessions", 0),
            ("avg_clicks_booking", "total_clicks_booking", "valid_bookings", 0),
            ("avg_clicks_cancellation", "total_clicks_cancellation", "total_cancellations", 0),
            ("avg_clicks_browsing", "total_clicks_browsing", "total_browsing_only", 0),
            ("avg_flight_price_per_km", "km_micros", "valid_flight_bookings", 6),
            ("avg_hotel_price_per_night", "room_cents", "valid_hotel_bookings", 2),
            ("avg_seats", "valid_seats", "valid_flight_bookings", 0),
            ("avg_bags", "valid_bags", "valid_flight_bookings", 0),
            ("avg_rooms", "valid_rooms", "valid_hotel_bookings", 0),
            ("avg_nights_combined", "nights_combined_flight_hotel", "valid_combined_bookings", 0),
            ("avg_nights_flight_total", "nights_flight_total", "valid_flight_bookings", 0),
            ("avg_nights_hotel_only", "nights_hotel_only", "hotel_bookings_only", 0),
            ("avg_nights_flight_only", "nights_flight_only", "flight_bookings_only", 0),
            (
                "avg_nights_total",
                "nights_combined_flight_hotel + nights_flight_only + nights_hotel_only",
                "valid_bookings",
                0,
            ),
            ("avg_leadtime_combined", "sum_leadtime_flight_hotel", "valid_combined_bookings", 0),
            ("avg_leadtime_hotel_only", "sum_leadtime_hotel_only", "hotel_bookings_only", 0),
            ("avg_leadtime_flight_only", "sum_leadtime_flight_only", "flight_bookings_only", 0),
        ]
    )
    + f"""
               , coalesce({quotient("short_weekday_trips", "valid_bookings", 4)}, 0) AS weekdays_travel_quote
               , coalesce({quotient("weekend_trips", "valid_bookings", 4)}, 0) AS weekend_travel_quote
               , (age >= 20 AND age <= 67)::INT AS is_in_working_age
        FROM totals""",
}

# flag: column, fraction, comparison
_LIMITS = {
    "is_quick_booker_p20": ("avg_min_booking", 0.2, "<"),
    "is_slow_booker_p80": ("avg_min_booking", 0.8, ">"),
    "is_low_clicks_booker_p20": ("avg_clicks_booking", 0.2, "<"),
    "is_high_clicks_booker_p80": ("avg_clicks_booking", 0.8, ">"),
    "is_short_leadtime_p20": ("avg_leadtime_combined", 0.2, "<"),
    "is_frequent_traveler_p80": ("valid_bookings", 0.8, ">"),
    "is_high_price_flight_p80": ("avg_flight_price_per_km", 0.8, ">"),
    "is_budget_price_flight_p20": ("avg_flight_price_per_km", 0.2, "<"),
    "is_high_price_hotel_p80": ("avg_hotel_price_per_night", 0.8, ">"),
    "is_budget_price_hotel_p20": ("avg_hotel_price_per_night", 0.2, "<"),
}


def _limit(column: str, p: float) -> str:
    if column == "valid_bookings":
        return f"quantile_disc({column}, {p})"
    return f"round(quantile_cont({column}::DOUBLE, {p}), 10)"


def _inverted(column: str) -> str:
    part = quotient(f"({column} - lo_{column}) * 10000", f"(hi_{column} - lo_{column}) * 10000", 4)
    return f"coalesce(1 - {part}, 0) AS {column}_norm_invert"


_SCALED = ("avg_bags", "avg_seats", "avg_nights_total")
_FEATURE_STEPS = {
    "limits": "SELECT "
    + ", ".join(f"{_limit(column, p)} AS {name}" for name, (column, p, _) in _LIMITS.items())
    + " FROM averages",
    "extremes": "SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in _SCALED)
    + " FROM averages",
    "features": "SELECT a.*, "
    + ", ".join(_inverted(c) for c in _SCALED)
    + ", "
    + ", ".join(
        f"coalesce({column}::DOUBLE {sign} l.{name}, false)::INT AS {name}"
        for name, (column, _, sign) in _LIMITS.items()
    )
    + f"""
               , (total_browsing_only = total_sessions OR (valid_bookings = 0 AND total_bookings >= 1))::INT
                   AS is_dreamer_no_bookings
               , coalesce(last_booking_since_signup <= 28, false)::INT AS is_new_customer_booking
               , coalesce(avg_seats BETWEEN 3 AND 6, false)::INT AS has_middle_num_seats
               , coalesce(avg_bags BETWEEN 1 AND 4, false)::INT AS has_middle_num_bags
               , coalesce(avg_rooms BETWEEN 1 AND 4, false)::INT AS has_middle_num_rooms
               , coalesce(valid_bookings >= 1 AND age >= 60, false)::INT AS is_senior_traveler
               , coalesce(valid_bookings >= 1 AND age <= 25, false)::INT AS is_young_traveler
               , coalesce({quotient("sum_discount_bookings", "valid_bookings", 4)}, 0) AS discount_booking_quote
               , coalesce({quotient("discount_flight_bookings", "valid_flight_bookings", 4)}, 0) AS discount_flight_quote
               , coalesce({quotient("discount_hotel_bookings", "valid_hotel_bookings", 4)}, 0) AS discount_hotel_quote
               , coalesce({quotient("domestic_flight_bookings", "valid_flight_bookings", 4)}, 0) AS domestic_flight_quote
               , coalesce({quotient("international_flight_bookings", "valid_flight_bookings", 4)}, 0)
                   AS international_flight_quote
               , coalesce({quotient("intercontinental_flight_bookings", "valid_flight_bookings", 4)}, 0)
                   AS intercontinental_flight_quote
        FROM averages a, limits l, extremes""",
    "scores": """
        SELECT *,
               if(coalesce(is_in_working_age, 1) = 1 AND weekdays_travel_quote >= 0.5,
                  0.2 * avg_bags_norm_invert + 0.2 * avg_seats_norm_invert + 0.6 * weekdays_travel_quote, 0)
                   AS score_business,
               if(has_children = 1, 0.2 * has_middle_num_seats + 0.1 * has_middle_num_rooms + 0.1 * has_middle_num_bags + 0.6, 0)
                   AS score_family,
               if(weekend_travel_quote >= 0.5, weekend_travel_quote, 0) AS score_weekender,
               is_frequent_traveler_p80 AS score_frequent_traveler, is_new_customer_booking AS score_new_booking_customer,
               is_dreamer_no_bookings AS score_dreamer, is_senior_traveler AS score_senior_traveler,
               is_young_traveler AS score_young_traveler,
               0.5 * is_high_price_hotel_p80 + 0.5 * is_high_price_flight_p80 AS score_premium_traveler,
               0.5 * is_budget_price_hotel_p20 + 0.5 * is_budget_price_flight_p20 AS score_budget_traveler,
               if(discount_booking_quote >= 0.5,
                  0.2 * is_high_clicks_booker_p80 + 0.2 * is_slow_booker_p80 + 0.6 * discount_booking_quote, 0)
                   AS score_deal_hunter
        FROM features""",
}

# Segment, score column, perk.
_SEGMENTS = {
    "Business": ("score_business", "Free Cancellation"),
    "Family": ("score_family", "Free Hotel Meal"),
    "Weekender": ("score_weekender", "Welcome Drink & Free Late Check-Out"),
    "Frequent Traveler": ("score_frequent_traveler", "Free Cancellation & Lounge"),
    "New Customer": ("score_new_booking_customer", "Free Hotel Night With Flight"),
    "Dreamer": ("score_dreamer", "Welcome Discount & 48h Free Cancellation"),
    "Senior Traveler": ("score_senior_traveler", "Free Hotel Meal"),
    "Young Traveler": ("score_young_traveler", "Welcome Drink & Free Late Check-Out"),
    "Premium Traveler": ("score_premium_traveler", "Priority Check-In & Lounge"),
    "Budget Traveler": ("score_budget_traveler", "Free Checked-Bag"),
    "Deal Hunter": ("score_deal_hunter", "Special Deal - Discount Offers"),
    "Others": (None, "Baseline Discount - TBD"),
}
_OPTIONAL = ("Weekender", "Senior Traveler")


def _segment_steps(extended: bool) -> dict[str, str]:
    chosen = {n: s for n, (s, _) in _SEGMENTS.items() if s and (extended or n not in _OPTIONAL)}
    tall = " UNION ALL ".join(f"SELECT user_id, '{n}' AS segment, {s}::DECIMAL(12,8) AS score FROM scores" for n, s in chosen.items())
    perks = ", ".join(f"('{n}', '{perk}')" for n, (_, perk) in _SEGMENTS.items())
    return {
        "tall": tall,
        "best": """
            SELECT user_id, segment AS assigned_segment, score, if(score < 0.3, 'Others', segment) AS final_segment
            FROM tall QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, segment) = 1""",
        "sizes": "SELECT final_segment, count(*) AS users, count(*) FILTER (score >= 0.5) AS good FROM best GROUP BY ALL",
        "summary": f"""
            SELECT final_segment, users, {quotient("users", "(SELECT count(*) FROM best)", 2)} AS share_perc,
                   {quotient("good", "users", 2)} AS good_match_perc, perk
            FROM sizes JOIN (VALUES {perks}) AS p(name, perk) ON name = final_segment""",
    }


def _yearly_steps(ytd: bool) -> dict[str, str]:
    """Year counts by comparing every user with every year, the straightforward way."""
    early = lambda day: f"strftime({day}, '%m%d') <= (SELECT strftime(latest, '%m%d') FROM cutoff)" if ytd else "true"
    registered = (
        "sign_up_date <= make_date(y.year, month(latest), day(latest))" if ytd else "year(sign_up_date) <= y.year"
    )
    return {
        "cutoff": "SELECT max(session_start) AS latest FROM sessions",
        "visits": f"SELECT *, year(session_start) AS year FROM sessions WHERE {early('session_start')}",
        "activity": """
            SELECT year, count(*) AS sessions, count(DISTINCT user_id) AS active_users,
                   count(DISTINCT trip_id) AS trips_booked
            FROM visits GROUP BY year""",
        "trip_counts": """
            SELECT year, user_id, count(DISTINCT trip_id) AS trips_user_year
            FROM visits WHERE trip_id IS NOT NULL GROUP BY ALL""",
        "bookers": """
            SELECT year, count(*) FILTER (trips_user_year > 1) AS repeat_bookers, count(*) AS bookers_total
            FROM trip_counts GROUP BY year""",
        "joins": f"""
            SELECT year(sign_up_date) AS year, count(DISTINCT user_id) AS new_users
            FROM users WHERE {early('sign_up_date')} GROUP BY ALL""",
        "spine": "SELECT year FROM activity UNION SELECT year FROM joins",
        "registered": f"""
            SELECT y.year, count(*) AS total_users FROM spine y JOIN (SELECT * FROM users, cutoff) ON {registered}
            GROUP BY y.year""",
        "counts": """
            SELECT year, coalesce(sessions, 0) AS sessions, coalesce(trips_booked, 0) AS trips_booked,
                   coalesce(active_users, 0) AS active_users, coalesce(new_users, 0) AS new_users,
                   coalesce(total_users, 0) AS total_users, coalesce(repeat_bookers, 0) AS repeat_bookers,
                   coalesce(bookers_total, 0) AS bookers_total,
                   coalesce(total_users, 0) - coalesce(active_users, 0) AS dormant_users
            FROM spine LEFT JOIN activity USING (year) LEFT JOIN joins USING (year) LEFT JOIN registered USING (year)
                 LEFT JOIN bookers USING (year)""",
        "lagged": "SELECT *, "
        + ", ".join(
            f"lag({c}) OVER (ORDER BY year) AS was_{c}"
            for c in ("sessions", "trips_booked", "active_users", "new_users", "total_users")
        )
        + " FROM counts",
        "kpis": "SELECT *, year AS the_year, year AS ytd_year, "
        + ", ".join(
            f"{quotient(num, den, 2)} AS {name}"
            for name, num, den in [
                ("growth_sessions_pct", "(sessions - was_sessions) * 100", "was_sessions"),
                ("growth_trips_pct", "(trips_booked - was_trips_booked) * 100", "was_trips_booked"),
                ("growth_active_users_pct", "(active_users - was_active_users) * 100", "was_active_users"),
                ("growth_new_users_pct", "(new_users - was_new_users) * 100", "was_new_users"),
                ("growth_total_users_pct", "(total_users - was_total_users) * 100", "was_total_users"),
                ("session_to_booking_conv_pct", "trips_booked * 100", "sessions"),
                ("trips_per_active_user", "trips_booked", "active_users"),
                ("sessions_per_active_user", "sessions", "active_users"),
                ("repeat_booker_share_pct", "repeat_bookers * 100", "bookers_total"),
                ("active_user_rate_pct", "active_users * 100", "total_users"),
                ("booker_rate_pct", "bookers_total * 100", "total_users"),
                ("dormant_rate_pct", "dormant_users * 100", "total_users"),
            ]
        )
        + " FROM lagged",
    }


def _retention_steps() -> dict[str, str]:
    """The self-join form: first year per user, joined with every year in which the user was seen again."""
    return {
        "cutoff": _yearly_steps(True)["cutoff"],
        "visits": _yearly_steps(True)["visits"],
        "seen": """
            SELECT DISTINCT 'active' AS cohort_type, user_id, year FROM visits
            UNION ALL SELECT DISTINCT 'booker', user_id, year FROM visits WHERE trip_id IS NOT NULL""",
        "firsts": "SELECT cohort_type, user_id, min(year) AS cohort_year_ytd FROM seen GROUP BY ALL",
        "cohort_sizes": "SELECT cohort_type, cohort_year_ytd, count(*) AS cohort_size FROM firsts GROUP BY ALL",
        "again": """
            SELECT cohort_type, cohort_year_ytd, year AS compare_year_ytd, count(DISTINCT user_id) AS retained_users
            FROM firsts JOIN seen USING (cohort_type, user_id) WHERE year >= cohort_year_ytd GROUP BY ALL""",
        "retention": f"""
            SELECT *, {quotient("retained_users * 100", "cohort_size", 2)} AS retention_rate_pct
            FROM again JOIN cohort_sizes USING (cohort_type, cohort_year_ytd)""",
    }


def _sql(name: str, steps: dict[str, str], source: str, where: str = "", **renamed: str) -> str:
    chosen = ", ".join(
        f"CAST({renamed.get(column, column)} AS {_TYPES[kind]}) AS {column}" for column, kind in COLUMNS[name]
    )
    ctes = ",\n".join(f"{cte} AS ({body})" for cte, body in {**_TABLES, **steps}.items())
    return f"WITH {ctes}\nSELECT {chosen} FROM {source}{' WHERE ' + where if where else ''}"


def oracle_sql() -> dict[str, str]:
    to_users = {**_SESSION_STEPS, **_USER_STEPS}
    to_scores = {**to_users, **_FEATURE_STEPS}
    to_summary = {**to_scores, **_segment_steps(False)}
    sql = {}
    for name in (
        "cohort_sessions session_join session_cleaning hotel_city session_time_features session_categories"
        " session_click_duration_split lead_times trip_length_flags flight_pricing"
    ).split():
        sql[name] = _sql(name, _SESSION_STEPS, "base")
    for name in ("flight_distance", "session_base"):
        sql[name] = _sql(name, _SESSION_STEPS, "base", flight_distance_km="round(km, 6)")
    sql["trip_status"] = _sql("trip_status", _SESSION_STEPS, "statuses")
    for name in (
        "user_browsing_totals user_booking_totals user_price_totals user_seat_room_night_totals user_info_totals"
        " user_averages"
    ).split():
        sql[name] = _sql(name, to_users, "averages")
    for name in ("feature_minmax", "feature_percentile_flags", "feature_conditions_quotes"):
        sql[name] = _sql(name, to_scores, "features")
    sql["percentile_limits"] = _sql("percentile_limits", to_scores, "limits")
    sql["user_scores"] = _sql("user_scores", to_scores, "scores")
    sql["user_scores_tall"] = _sql("user_scores_tall", to_summary, "tall")
    for name in ("assigned_segments", "assignment_inspection"):
        sql[name] = _sql(name, to_summary, "best")
    for name in ("segment_summary", "segment_summary_short"):
        sql[name] = _sql(name, to_summary, "summary")
    sql["segment_summary_extended"] = _sql(
        "segment_summary_extended", {**to_scores, **_segment_steps(True)}, "summary"
    )
    for name, source in (
        ("sessions_by_year", "activity"),
        ("repeat_bookers_by_year", "bookers"),
        ("trips_per_user_year", "trip_counts"),
        ("new_users_by_year", "joins"),
        ("total_users_by_year", "registered"),
    ):
        sql[name] = _sql(name, _yearly_steps(False), source)
        sql[f"{name}_ytd"] = _sql(f"{name}_ytd", _yearly_steps(True), source)
    sql["ytd_cutoff"] = _sql(
        "ytd_cutoff", _yearly_steps(True), "cutoff", max_sess_date="latest::DATE", m="month(latest)", d="day(latest)"
    )
    sql["kpi_full_year"] = _sql("kpi_full_year", _yearly_steps(False), "kpis")
    for name in ("kpi_ytd", "kpi_dashboard"):
        sql[name] = _sql(name, _yearly_steps(True), "kpis")
    sql["retention_active"] = _sql("retention_active", _retention_steps(), "retention", "cohort_type = 'active'")
    sql["retention_booker"] = _sql("retention_booker", _retention_steps(), "retention", "cohort_type = 'booker'")
    sql["retention_heatmap"] = _sql("retention_heatmap", _retention_steps(), "retention", "cohort_year_ytd = 1995")
    for name in ("trip_status", "session_base", "user_averages", "segment_summary"):
        sql[f"{name}_large"] = sql[name]  # another route to the same rows
    for name in ("trip_status", "cohort_sessions"):
        sql[f"{name}_laid_out"] = sql[name]
    chosen = "user_id IN (1, 2, 4, 5, 7, 8, 10, 11, 13, 14, 16, 17, 19, 20, 22, 23, 25, 26, 28, 29)"
    sql["session_inspection"] = _sql("session_inspection", _SESSION_STEPS, "base", chosen, flight_distance_km="round(km, 6)")
    sql["user_inspection"] = _sql("user_inspection", to_users, "averages", chosen)
    return sql
