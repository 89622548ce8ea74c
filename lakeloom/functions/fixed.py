"""Fixed values that results depend on."""

# Letter grades with their points, W (withdrawn) has none.
GRADE_POINTS = {
    "A": 4.0, "A-": 3.7, "B+": 3.3, "B": 3.0, "B-": 2.7,
    "C+": 2.3, "C": 2.0, "D": 1.0, "F": 0.0, "W": None,
}
# How often each grade is drawn, in the order above.
GRADE_WEIGHTS = [20, 15, 16, 15, 9, 8, 7, 3, 2, 5]

# The formats a birth date may be written in.
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "dd.MM.yyyy"]

# Student status to standing, and the standing of all others.
STANDING = {"active": "In Good Standing", "graduated": "Alumnus"}
OTHER_STANDING = "Inactive"

# Raw run states to reported status.
RUN_STATUS = {
    "Succeeded": ["SUCCEEDED", "FINISHED", "COMPLETED"],
    "Failed": ["ERROR", "FAILED", "TIMEDOUT"],
    "Canceled": ["CANCELED", "CANCELLED"],
}

# Lower bounds of the grade-point bands, best first.
POINT_BANDS = [(3.7, "3.7 and up"), (3.3, "3.3 to 3.7"), (3.0, "3.0 to 3.3"),
               (2.7, "2.7 to 3.0"), (2.0, "2.0 to 2.7")]
LOWEST_BAND, NULL_BAND = "below 2.0", "withdrawn"

# Latency tiers in ms (upper bound, label) and the open last tier.
TIERS = [(1000, "1 Fast (<1s)"), (5000, "2 Medium (1-5s)")]
LAST_TIER = "3 Slow (>5s)"
BUCKETS = [(1000, "< 1s"), (5000, "1-5s"), (10000, "5-10s"), (30000, "10-30s")]
LAST_BUCKET = "> 30s"

# Column-name fragments that mark sensitive data.
SENSITIVE = ["ssn", "dob", "amount", "email"]
