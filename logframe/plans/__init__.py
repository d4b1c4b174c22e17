"""Looking at plans, for tests."""

from logframe.plans.inspect import formatted_plan, plan_facts

__all__ = ["formatted_plan", "plan_facts"]
