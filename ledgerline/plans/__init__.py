"""Cleaning plans, business marts, dashboard reports and the stage drivers."""
