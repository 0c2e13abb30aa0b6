"""kinlink.plans"""
