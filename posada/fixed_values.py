"""Labels, column lists and patterns the output tables must carry."""

# Calendar labels, January first and Monday first.
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
               "Septiembre", "Octubre", "Noviembre", "Diciembre"]
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]

# Price classes per night, each [lower, upper).
PRICE_CLASSES = [("Económico", 0, 100_000), ("Medio", 100_000, 200_000),
                 ("Alto", 200_000, 400_000), ("Lujo", 400_000, float("inf"))]

# Defaults for missing text.
NO_PRICE = "Sin precio"
NO_INFORMATION = "Sin información"
NO_LICENSE = "Sin registro"

# Column groups of the listings table.
VALUELESS_COLUMNS = ["picture_url", "host_url", "host_profile_url", "host_picture_url",
                     "host_thumbnail_url", "scrape_id"]
FLAG_COLUMNS = ["host_is_superhost", "host_has_profile_pic", "host_identity_verified",
                "has_availability", "instant_bookable"]
LISTING_DATE_COLUMNS = ["last_scraped", "host_since", "first_review", "last_review",
                        "calendar_last_scraped", "price_quote_checkin_date",
                        "price_quote_checkout_date"]
PRICE_COLUMNS = ["price", "price_quote_total_price", "price_quote_price_per_night"]
DEFAULTED_TEXT_COLUMNS = ["name", "description", "host_about", "host_location"]
CLEANED_TEXT_COLUMNS = ["name", "description", "host_about"]
IMPUTED_COLUMNS = ["bedrooms", "beds", "bathrooms", "minimum_nights"]
HOST_PREFIXES = ["host_", "hosts_", "calculated_host_listings_count"]

# Columns known to hold text, so that landing need not test their values for numbers.
KNOWN_TEXT_COLUMNS = ["date", "available", "comments", "reviewer_name", "name", "description",
                      "amenities", "price", "price_quote_raw", "room_type", "neighbourhood_cleansed",
                      "bathrooms_text", "host_name", "host_about", "host_location", "picture_url",
                      *FLAG_COLUMNS, *LISTING_DATE_COLUMNS]

# Tokens that count as missing in raw CSV text.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Sheet limits of a spreadsheet extract and the tables that go together.
SHEET_MAX_ROWS = 1_048_575
SHEET_MAX_CHARS = 32_767
EXPORT_GROUPS = {
    "listings": ["listings", "hosts", "listing_amenities"],
    "reviews": ["reviews"],
    "calendario_resumen": ["calendar_mensual", "calendar_semanal", "calendar"],
}

# Lookup columns per output table (see sinks.tables).
LOOKUP_COLUMNS = {
    "listings": ["id", "host_id", "neighbourhood_cleansed"],
    "hosts": ["host_id"],
    "listing_amenities": ["listing_id", "amenity"],
    "calendar": ["listing_id", "date"],
    "calendar_mensual": ["listing_id"],
    "reviews": ["listing_id", "date"],
}
# Tables that are split into one folder per value, as most readers want some months only.
PARTITION_COLUMNS = {"calendar": ["anio", "mes"], "calendar_mensual": ["anio", "mes"]}
LANDING_ORDER = {"listings": ["id"], "reviews": ["listing_id", "date"],
                 "calendar": ["listing_id", "date"]}

# Run-log marker and the fragments that make a log line worth keeping.
RUN_START = "INICIO DEL PROCESO ETL"
LOG_FRAGMENTS = ["INICIO", "Conexión establecida", "registros extraídos", "WARNING", "ERROR",
                 "Tratamiento de nulos", "Desanidado", "Resumen mensual", "SQLite: tabla",
                 "XLSX:", "Verificación", "Etapa de", "FIN DEL PROCESO"]

# Edges of the availability bins, each (lower, upper].
AVAILABILITY_EDGES = [-1, 0, 90, 180, 270, 364, 365]

# Columns of the rank-correlation matrix.
CORRELATED_COLUMNS = ["precio", "accommodates", "bedrooms", "beds", "bathrooms", "minimum_nights",
                      "availability_365", "number_of_reviews", "reviews_per_month",
                      "review_scores_rating", "estimated_occupancy_l365d"]
