"""Output labels of the analytics.

Fixed values: these strings are the labels the source queries emit, per query, in
the order of their CASE branches (first branch first, ELSE last). They must stay
equal to the source's text for the results to match.
"""

Y1_PERFORMANCE_TIER = ("EXCELLENT", "GOOD", "ACCEPTABLE", "NEEDS ATTENTION")
Y2_TREND_STATUS = ("🔴 SIGNIFICANT DROP", "🟡 MINOR DROP", "🟢 IMPROVED", "⚪ STABLE")
Y4_DISPOSITION = ("EXCELLENT", "GOOD", "MARGINAL", "REJECT")
Y5_PRIORITY = ("🔴 HIGH PRIORITY", "🟡 MEDIUM PRIORITY", "🟢 LOW PRIORITY")
Y7_INTERPRETATION = ("⚠️ High utilization hurts yield", "🟡 Moderate negative correlation",
                     "✅ No significant correlation")

E1_HEALTH_STATUS = ("🟢 EXCELLENT", "🟡 GOOD", "🟠 ACCEPTABLE", "🔴 NEEDS ATTENTION")
E2_RELIABILITY = ("🟢 EXCELLENT (>30 days)", "🟡 GOOD (15-30 days)", "🟠 ACCEPTABLE (7-15 days)",
                  "🔴 POOR (<7 days)")
E3_ALARM_SEVERITY = ("🔴 CRITICAL - Immediate intervention needed", "🟠 HIGH - Schedule maintenance",
                     "🟡 MEDIUM - Monitor closely", "🟢 LOW - Normal operations")
E4_DEGRADATION = ("🔴 HIGH RISK - Degradation detected", "🟡 MODERATE RISK - Monitor closely", "🟢 STABLE")
E5_EFFECTIVENESS = ("🟢 HIGHLY EFFECTIVE", "🟡 MODERATELY EFFECTIVE", "🔴 LIMITED EFFECTIVENESS")
E6_CRITICALITY = ("🔴 TIER 1 - Critical Equipment", "🟠 TIER 2 - Important Equipment",
                  "🟡 TIER 3 - Standard Equipment", "🟢 TIER 4 - Low Impact Equipment")
R2_HEALTH_STATUS = ("CRITICAL", "WARNING", "HEALTHY")

B1_STATUS_INDICATOR = ("❌ FAILED HERE", "✓")
B2_ROOT_CAUSE = ("🔴 Multiple equipment issues", "🟡 Post-maintenance instability",
                 "🟠 Systematic process issue at ", "🔵 Further investigation needed")
B3_SEVERITY = ("🔴 HIGH IMPACT COMBO", "🟡 MODERATE IMPACT", "🟢 LOW IMPACT")
B5_INTERPRETATION = ("🔴 STRONG CORRELATION - Process drift likely", "🟡 MODERATE CORRELATION - Monitor",
                     "🟢 INDEPENDENT BATCHES - Normal")
B6_DISPOSITION = ("IN PROGRESS", "RELEASED", "CONDITIONAL RELEASE", "QUARANTINE")
B7_CONTAMINATION_RISK = ("🔴 POSSIBLE CONTAMINATION - No cleaning between low-yield batches",
                         "🟠 SUDDEN DROP - Investigate chamber condition", "🟢 MAINTENANCE EFFECTIVE",
                         "⚪ NORMAL VARIATION")
