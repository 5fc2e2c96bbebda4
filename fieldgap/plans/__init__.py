"""The vehicle-safety models: staging, intermediate, marts, reports and data tests."""
