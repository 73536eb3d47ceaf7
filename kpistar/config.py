"""Report parameters: tenant, period, brand code, reporting time zone."""

from __future__ import annotations

from dataclasses import dataclass

# Tenant (database) name -> brand id, as used by the legacy
# single-brand reports.
TENANT_BRAND_IDS = {"loreal": 1, "matrix": 5, "luxe": 6, "redken": 7, "essie": 3}


@dataclass(frozen=True)
class ReportParams:
    # Half-open [lo, hi) ranges on the event start, in report time zone.
    period: tuple = (("1996-01-01", "1997-09-01"),)
    # Calendar years for the brand-version report (string years as in to_char).
    years: tuple = ("1996", "1997")
    # Brand code for the brand-version report.
    brand_code: str = "AM"
    # Tenant of the legacy single-brand reports.
    tenant: str = "loreal"
    # Reporting time zone used for `ts AT TIME ZONE 'UTC'` style shifts.
    report_tz: str = "UTC"
    # Programme years of the legacy reports (previous, current).
    program_years: tuple = ("1996", "1997")
    # Legacy seminar KPI period and the two legacy salon KPI quarters.
    legacy_period: tuple = (("1996-01-01", "1997-06-01"),)
    legacy_salon_period: tuple = (("1996-01-01", "1996-04-01"), ("1997-01-01", "1997-04-01"))
    # Name of the commercial macro-region excluded as test data.
    excluded_mreg: str = "ASIA"

    @property
    def tenant_brand_id(self) -> int | None:
        return TENANT_BRAND_IDS.get(self.tenant)
