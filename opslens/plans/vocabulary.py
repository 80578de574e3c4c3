"""The spellings, labels and limits the results depend on."""

# Flags with three states (yes, no, not known).
YES_WORDS = ["yes", "1", "true", "y"]
NO_WORDS = ["no", "0", "false", "n"]

# Flags with two states; everything else is "not set".
SET_WORDS = ["yes", "true", "1"]

# Trip status.
STATUS_WORDS = {
    "On Time": ["on time", "ontime", "ot"],
    "Delayed": ["delayed", "delay"],
    "Cancelled": ["cancelled"],
}
STATUS_DEFAULT = "Unknown"

# Gender.
GENDER_WORDS = {
    "Male": ["l", "m", "male", "laki", "laki-laki"],
    "Female": ["p", "f", "female", "perempuan"],
}
GENDER_DEFAULT = "Unknown"

# Ticket class; an unknown class counts as Economy.
CLASS_WORDS = {
    "Economy": ["ekonomi", "economy", "eco"],
    "Business": ["business", "biz", "c"],
    "First": ["first"],
}
CLASS_DEFAULT = "Economy"

# Incident severity, as words or digits.
SEVERITY_WORDS = {
    "Low": ["low", "1"],
    "Medium": ["medium", "2"],
    "High": ["high", "3"],
    "Critical": ["critical", "4"],
}
SEVERITY_DEFAULT = "Unknown"
SEVERITY_ORDER = ["Low", "Medium", "High", "Critical"]

# Other labels.
ALLIANCE_DEFAULT = "None"
ACTIVE_STATUS = "active"
NO_INCIDENT = "No Incident"
LOYAL_LABEL = "Frequent Flyer"
REGULAR_LABEL = "Regular"
DEPARTURES = "Departures"
ARRIVALS = "Arrivals"

# Route grades as (label, highest mean delay, lowest on-time percentage).
GRADE_LIMITS = [("Excellent", 5, 80), ("Good", 20, 60), ("Fair", 45, None)]
GRADE_DEFAULT = "Poor"

# Route types by how many ends are international.
BOTH_INTERNATIONAL = "Intl–Intl"
ONE_INTERNATIONAL = "Intl–Dom"
NONE_INTERNATIONAL = "Dom–Dom"

# Punctuality target in percent, histogram bins, length of the top list.
ON_TIME_TARGET = 80
DELAY_BINS = 8
TOP_PLACES = 7
